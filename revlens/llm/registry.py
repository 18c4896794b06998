"""The operators' queries, by name, and their SQL twins. The paths of public vocabularies
are looked up here and handed on as parameters."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import (
    bpe, codes, decontaminate, html, lines, negatives, neighbours, packing, quality, secrets, simhash,
    suffixes, warc,
)
from revlens.llm.common import hex64, read, texts
from revlens.runtime import fresh_path

# The end of text that the packing contract names.
END_ID = 2


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = texts(read(spark, sf_dir, "documents")).select(
        "doc_id", bpe.encode(F.col("text"), path, public_tokenizers.PATTERN).alias("ids"))
    return ids.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select(
        F.col("page_id").cast("long").alias("page_id"), html.visible_text(F.col("html")).alias("text"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64("fp").alias("fingerprint"), "component_id")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return lines.without_repeated_lines(docs).select(
        "doc_id", "text", F.col("line_counts.lines").alias("n_lines"),
        F.col("line_counts.dropped").alias("n_dropped"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.packed(read(spark, sf_dir, "documents"), path, END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write(warc.page_records(read(spark, sf_dir, "pages")), path)
    responses = warc.load(spark, path).filter("record_type = 'response'").select(
        warc.page_of("record_id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = warc.load(spark, path, payload="false").filter("record_type = 'revisit'").select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes",
        F.col("payload_sha1").alias("payload_digest"), "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(read(spark, sf_dir, "documents"))
    found = docs.select(
        "doc_id", secrets.scan(F.col("text"), secrets.common_words(docs)).alias("found"))

    def number(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.concat_ws(",", F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    base = F.filter("found", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"),
        number("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read(spark, sf_dir, "embeddings"), label, "vec_id % 100 = 0")


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_html": op2_html,
    "op3_neighbours": op3_neighbours,
    "op4_simhash": op4_simhash,
    "op5_lines": op5_lines,
    "op6_packing": op6_packing,
    "op7_warc": op7_warc,
    "op8_suffixes": op8_suffixes,
    "op9_secrets": op9_secrets,
    "op10_quality": op10_quality,
    "op11_negatives": op11_negatives,
    "op12_decontaminate": op12_decontaminate,
    "op13_codes": op13_codes,
}

ORACLE_SQL = {
    "op5_lines": r"""
        with place as (
            select doc_id, i - 1 as line_no, string_split(text, chr(10))[i] as line
            from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i
                  from documents)),
        worded as (
            select doc_id, line_no, line, w, len(w) as n, array_to_string(w, ' ') as norm
            from (select *, list_filter(string_split_regex(line, '[\x09-\x0D\x20]+'),
                                        lambda x: x <> '') as w from place)
            where len(w) >= 1),
        every as (
            select norm, any_value(w) as w, any_value(n) as n,
                   min((doc_id, line_no)) as first
            from worded group by norm),
        firsts as (select * from every where n >= 5),
        deletions as (
            select norm, first, n - 1 as m, i as slot,
                   md5(array_to_string(list_concat(w[:i - 1], w[i + 1:]), ' ')) as variant
            from (select *, unnest(range(1, n + 1)) as i from firsts)),
        wholes as (select norm, first, n as m, md5(norm) as variant from firsts),
        edited as (
            select norm from (
                select norm, first, min(first) over (partition by variant, m, slot) as least
                from deletions) where least < first
            union
            select d.norm from deletions d join wholes w using (variant, m) where w.first < d.first
            union
            select w.norm from deletions d join wholes w using (variant, m) where d.first < w.first),
        dropped as (
            select l.doc_id, l.line_no
            from worded l join every f using (norm) left join edited e using (norm)
            where e.norm is not null or f.first <> (l.doc_id, l.line_no)),
        kept as (
            select p.doc_id, string_agg(p.line, chr(10) order by p.line_no) as text
            from place p anti join dropped d on d.doc_id = p.doc_id and d.line_no = p.line_no
            group by p.doc_id),
        counts as (
            select p.doc_id, count(*) as n_lines, count(d.line_no) as n_dropped
            from place p left join dropped d on d.doc_id = p.doc_id and d.line_no = p.line_no
            group by p.doc_id)
        select o.doc_id,
               case when o.text is null then null else coalesce(k.text, '') end as text,
               coalesce(c.n_lines, 0) as n_lines, coalesce(c.n_dropped, 0) as n_dropped
        from documents o left join kept k using (doc_id) left join counts c using (doc_id)""",
    "op7_warc": """
        with pages_sha as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes,
                   sha1(coalesce(html, '')) as payload_digest
            from pages),
        firsts as (
            select *, case when payload_bytes >= 1000 then
                       max(page_id) over (partition by payload_digest, payload_bytes)
                       else page_id end as response
            from pages_sha)
        select page_id, payload_bytes, payload_digest,
               case when page_id = response then 'response' else 'revisit' end as record_type,
               case when page_id <> response then response end as refers_to
        from firsts""",
    "op11_negatives": """
        with kept as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
            from embeddings
            where label is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scores as (
            select a.vec_id as anchor_id, o.vec_id, a.label = o.label as same,
                   cast(list_inner_product(a.v, o.v) as bigint) as score
            from kept a join kept o on a.vec_id % 100 = 0 and o.vec_id <> a.vec_id),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score
            from scores where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select p.anchor_id, positive_id,
               row_number() over (partition by p.anchor_id, positive_id
                                  order by score desc, vec_id) as rank,
               vec_id as negative_id, positive_score, score as negative_score
        from positives p join scores s on s.anchor_id = p.anchor_id and not same
             and 100 * score between 30 * positive_score and 90 * positive_score
        qualify rank <= 10""",
    "op12_decontaminate": r"""
        with doc_words as (
            select doc_id, list_filter(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda x: x <> '') as w from documents),
        item_words as (
            select item_id, list_filter(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda x: x <> '') as w from benchmark),
        windows as (
            select distinct item_id, least(10, len(w)) as width,
                   array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as run
            from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
                  from item_words where len(w) > 0)),
        runs as (
            select doc_id, i, width, array_to_string(w[i:i + width - 1], ' ') as run
            from (select doc_id, w, width, unnest(range(1, len(w) - width + 2)) as i
                  from doc_words, (select distinct width from windows) where len(w) >= width)),
        found as (select r.*, item_id from runs r join windows using (width, run)),
        hits as (
            select doc_id, count(distinct place) as n_hit
            from (select doc_id, unnest(range(i, i + width)) as place from found) group by doc_id),
        items as (
            select doc_id, count(*) as n_items,
                   string_agg(item, ',' order by item) as ids
            from (select distinct doc_id, cast(item_id as varchar) as item from found)
            group by doc_id)
        select d.doc_id, coalesce(len(w), 0) as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
               n_hit is not null as contaminated
        from doc_words d left join hits using (doc_id) left join items using (doc_id)""",
    "op13_codes": """
        with kept as (
            select row_number() over (order by vec_id) - 1 as r, vec_id, label,
                   list_transform(embedding, lambda x:
                       cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where len(embedding) > 0 and len(embedding) % 16 = 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        parts as (
            select r, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] as v
            from kept, (select unnest(range(16)) as p)),
        book0 as (select p, r as e, v from parts where r < 64),
        assigned0 as (
            select r, p, min(d * 64 + e) as best
            from (select x.r, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
                  from parts x join book0 b using (p))
            group by r, p),
        means1 as (
            select p, e, list(mean order by i) as v
            from (select p, e, i, cast(floor(sum(v[i]) / count(*)) as bigint) as mean
                  from (select p, best % 64 as e, v, unnest(range(1, len(v) + 1)) as i
                        from assigned0 join parts using (r, p))
                  group by p, e, i)
            group by p, e),
        book1 as (
            select p, e, coalesce(m.v, b.v) as v from book0 b left join means1 m using (p, e)),
        assigned1 as (
            select r, p, min(d * 64 + e) as best
            from (select x.r, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
                  from parts x join book1 b using (p))
            group by r, p),
        means2 as (
            select p, e, list(mean order by i) as v
            from (select p, e, i, cast(floor(sum(v[i]) / count(*)) as bigint) as mean
                  from (select p, best % 64 as e, v, unnest(range(1, len(v) + 1)) as i
                        from assigned1 join parts using (r, p))
                  group by p, e, i)
            group by p, e),
        book2 as (
            select p, e, coalesce(m.v, b.v) as v from book1 b left join means2 m using (p, e)),
        assigned2 as (
            select r, p, min(d * 64 + e) as best
            from (select x.r, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
                  from parts x join book2 b using (p))
            group by r, p),
        codes as (
            select r, string_agg(format('{:02x}', best % 64), '' order by p) as code,
                   cast(sum(best // 64) as bigint) as error
            from assigned2 group by r),
        digest as (
            select sha256(string_agg(cast(x as varchar), ',' order by p, e, i)) as digest
            from (select p, e, unnest(v) as x, unnest(range(len(v))) as i from book2))
        select vec_id, code, error,
               cast(sum(error) over (partition by label) as bigint) as label_error,
               digest as codebooks_sha256
        from kept join codes using (r), digest""",
}
