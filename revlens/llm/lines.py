"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared as sequences of words (separated by blanks, tabs and line ends). A line is dropped if
an equal line stands earlier: in a smaller doc_id, or higher up in the same document. A line of at least
`MIN_WORDS` words is also dropped if another one of at least so many, within one word's edit of it (a
word replaced, inserted or deleted), stands earlier; among fewer words one edit leaves little in common.
Lines without words always stay. Every line is judged on the input, whatever happens to the earlier one.

A line stands for itself and for all its one-word deletions. Two lines are within one edit exactly if
they share a deletion at the same place (replaced word) or one is a deletion of the other
(inserted word), so hashed deletions are joined, and each line is compared with the earliest partner at
a key only: at the same key and place all lines are mutual partners, so no pairs are made. Links are
verified on the words.

A line has as many deletions as words, so a sieve comes first that loses no link: lines within
one edit agree in their first or in their last half (of the shorter one's words). Only lines that share such
a half with a different line emit deletions; theirs come from words fetched once more by document.
Texts are shuffled twice, by document: to fetch those words, and to apply the decisions.

Defined results: null texts stay null, empty texts empty; rows that share a doc_id are one place, so
what is first in one is first in the others; each row without id is a document of its own, after
all others, by a hash of its text (equal texts in any order); a document may lose
all its lines and then keeps an empty text; no document is dropped. Line ends are `\\n`; the kept lines
are joined by it unchanged. Columns beside the text are handed through.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialized

MIN_WORDS = 5
BLOCK = 16
_SEPARATORS = "\t\n\x0b\x0c\r "
_LAST = str(1 << 63)  # the first document without id
_ROWS = str(1 << 63)
_LINES_OF_DOCUMENT = 1 << 31
_ROW = "_row_without_id"


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number in `_ROW` for each row without id: 31 bits of its text's hash,
    then its place in the table. Only these rows are stored, so that the number stays the same."""
    whole = "decimal(38,0)"
    upper = F.pmod(F.xxhash64("text"), F.lit(1 << 31)).cast(whole) * F.lit(_ROWS).cast(whole)
    number = (F.lit(_LAST).cast(whole) + upper + F.monotonically_increasing_id()).cast(whole)
    without = materialized(
        docs.filter("doc_id is null").withColumn(_ROW, number), "documents-without-id")
    return docs.filter("doc_id is not null").withColumn(_ROW, F.lit(None).cast(whole)).unionByName(
        without)


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("decimal(38,0)"), F.col(_ROW))


def _plain(line: Column) -> Column:
    """The line's words with single blanks between them, empty if it has none. Most lines have
    single blanks only, which no regular expression needs to look at."""
    trimmed = F.btrim(line, F.lit(_SEPARATORS))
    other = F.contains(trimmed, F.lit("  "))
    for separator in _SEPARATORS.replace(" ", "").replace("\n", ""):
        other |= F.contains(trimmed, F.lit(separator))
    return F.when(other, F.regexp_replace(trimmed, "[\\x09-\\x0D\\x20]+", " ")).otherwise(trimmed)


def _identity(plain: Column) -> tuple[Column, Column]:
    """128 bits that name a line."""
    return F.xxhash64(plain), F.xxhash64(F.lit("other"), plain)


def _lines(docs: DataFrame) -> DataFrame:
    """place (orders lines as they stand in the corpus), doc, line_no, n, plain, of all lines
    that have words."""
    doc = _doc()
    return (
        # outer and a filter on the ends alone: Spark runs filters once more, below
        docs.select(doc.alias("doc"), F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
        .filter(F.btrim("line", F.lit(_SEPARATORS)) != "")
        .select("doc", "line_no", _plain(F.col("line")).alias("plain"))
        .withColumn("n", F.octet_length("plain") - F.octet_length(
            F.replace("plain", F.lit(" "), F.lit(""))) + 1)
        .withColumn("place", (F.col("doc") * _LINES_OF_DOCUMENT + F.col("line_no"))
                    .cast("decimal(38,0)"))
    )


def _half_keys() -> list[Column]:
    """Hashes of the first and last half, for partners as long or one word shorter or longer."""
    keys = []
    for half in ("floor(n / 2)", "floor((n - 1) / 2)"):
        for name, sign in (("first", ""), ("last", "-")):
            keys.append(F.xxhash64(F.lit(name), F.expr(
                f"substring_index(plain, ' ', {sign}cast({half} as int))")))
    return keys


def _named_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """Each line's place, doc and line_no, its identity h1, h2, and its half keys."""
    h1, h2 = _identity(F.col("plain"))
    a, b, c, d = _half_keys()
    long = F.col("n") >= min_words  # shorter lines are compared with equal ones alone
    even = long & (F.col("n") % 2 == 0)  # odd lengths have one half only
    return _lines(docs).select(
        "place", "doc", "line_no", h1.alias("h1"), h2.alias("h2"),
        F.when(long, a).alias("k1"), F.when(long, b).alias("k2"),
        F.when(even, c).alias("k3"), F.when(even, d).alias("k4"))


def _distinct_lines(named: DataFrame) -> DataFrame:
    """One row per different line: h1, h2, its first place, how often it occurs, half keys."""
    return named.groupBy("h1", "h2", "k1", "k2", "k3", "k4").agg(
        F.min("place").alias("place"), F.count("*").alias("times"))


def _sieved(distinct: DataFrame) -> DataFrame:
    """h1, h2, place of the lines that share a half with a different line."""
    halves = distinct.select(
        "h1", "h2", "place",
        F.explode(F.array_compact(F.array("k1", "k2", "k3", "k4"))).alias("half"))
    shared = halves.groupBy("half").agg(
        F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low <> high").select("half")
    return halves.join(shared, "half", "left_semi").select("h1", "h2", "place").distinct()


def _fetched(docs: DataFrame, sieved: DataFrame) -> DataFrame:
    """The words of lines, from the documents where they stand first: place, h1, h2, words, n."""
    where = sieved.select(
        "h1", "h2", "place",
        F.floor(F.col("place") / _LINES_OF_DOCUMENT).cast("decimal(38,0)").alias("doc"),
    ).groupBy("doc").agg(F.collect_list(F.struct("h1", "h2", "place")).alias("wanted"))
    doc = _doc()
    line_no = (F.col("line.place") - F.col("doc") * _LINES_OF_DOCUMENT).cast("int")
    own = F.get(F.split("text", "\n"), line_no)
    # the generator of one element holds a line: the filter below would go through a plain
    # projection, and split the text anew wherever it looks at the line
    found = (
        docs.select(doc.alias("doc"), "text").join(where, "doc")
        .select("doc", "text", F.explode("wanted").alias("line"))
        .select(F.inline(F.array(F.struct("line", own.alias("own")))))
        .withColumn("plain", _plain(F.col("own")))
    )
    h1, h2 = _identity(F.col("plain"))
    return (
        found.filter((h1 == F.col("line.h1")) & (h2 == F.col("line.h2")))
        .select("line.place", "line.h1", "line.h2", F.split("plain", " ").alias("words"))
        .withColumn("n", F.size("words"))
        .dropDuplicates(["h1", "h2"])
    )


def _prefixes(hashes: Column) -> Column:
    """xor of the hashes before each index. Blocks keep the cost at BLOCK per word."""

    def folded(part):
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / BLOCK).cast("int")),
        lambda b: folded(F.slice(hashes, b * BLOCK + 1, F.lit(BLOCK))))
    before_block = F.aggregate(
        blocks, F.array(F.lit(0).cast("long")),
        lambda a, x: F.array_append(a, F.element_at(a, -1).bitwiseXOR(x)))
    return F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 1),
        lambda i: F.get(F.col("_before"), F.floor(i / BLOCK).cast("int")).bitwiseXOR(
            folded(F.slice(hashes, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)))
    ), before_block


def _with_prefixes(rows: DataFrame, hashes: str, out: str) -> DataFrame:
    """The rows with the prefixes of a column of hashes. The generator of one element holds the
    blocks' prefixes: two plain projections would be merged, and the lambda that reads them would
    compute all blocks anew for every word."""
    prefixes, before = _prefixes(F.col(hashes))
    held = rows.select(F.inline(F.array(F.struct(*rows.columns, before.alias("_before")))))
    return held.withColumn(out, prefixes).drop("_before")


def _variants(lines: DataFrame) -> DataFrame:
    """(variant, m, slot, place): a line itself (slot -1) and its deletions (slot: the word left
    out), named by the xor of all words hashed with their positions, and their m words."""
    rows = (
        lines.withColumn("at", F.transform("words", lambda w, i: F.xxhash64(w, i)))
        .withColumn("shifted", F.transform("words", lambda w, i: F.xxhash64(w, i - 1)))
    )
    rows = _with_prefixes(_with_prefixes(rows, "at", "before"), "shifted", "before_shifted")
    rows = rows.withColumns({
        "whole": F.get("before", F.col("n") - 1).bitwiseXOR(F.element_at("at", -1)),
        "whole_shifted": F.get("before_shifted", F.col("n") - 1).bitwiseXOR(
            F.element_at("shifted", -1)),
    })
    deletions = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.struct(
            F.get("before", i).bitwiseXOR(F.col("whole_shifted")).bitwiseXOR(
                F.get("before_shifted", i)).bitwiseXOR(F.get("shifted", i)).alias("variant"),
            (F.col("n") - 1).alias("m"), i.alias("slot")))
    itself = F.array(F.struct(
        F.col("whole").alias("variant"), F.col("n").alias("m"), F.lit(-1).alias("slot")))
    return rows.select("place", F.inline(F.concat(itself, deletions)))


def _links(variants: DataFrame) -> DataFrame:
    """(place, earlier): each line with the earliest partner at each of its keys."""
    deletions = variants.filter("slot >= 0")
    lines = variants.filter("slot < 0").drop("slot")
    first_at_slot = deletions.groupBy("variant", "m", "slot").agg(
        F.min("place").alias("earlier"), F.count("*").alias("k")).filter("k > 1").drop("k")
    replaced = deletions.join(first_at_slot, ["variant", "m", "slot"])
    longer = deletions.join(
        lines.withColumnRenamed("place", "earlier"), ["variant", "m"])
    shorter = lines.join(
        deletions.groupBy("variant", "m").agg(F.min("place").alias("earlier")), ["variant", "m"])
    pairs = [p.filter("earlier < place").select("place", "earlier")
             for p in (replaced, longer, shorter)]
    return pairs[0].union(pairs[1]).union(pairs[2]).distinct()


def one_edit(a: Column, b: Column) -> Column:
    """True if word arrays differ by one word at most."""
    different = F.array_position(
        F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    rest_a, rest_b = F.size(a) - F.size(b), F.size(b) - F.size(a)

    def after(words, skipped):
        start = different + skipped
        return F.slice(words, start, F.greatest(F.size(words) - start + 1, F.lit(0)))

    return (different == 0) | F.when(rest_a == 0, after(a, 1) == after(b, 1)).when(
        rest_a == 1, after(a, 1) == after(b, 0)).when(
        rest_b == 1, after(a, 0) == after(b, 1)).otherwise(False)


def _edited(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """h1, h2 of lines with an earlier line within one edit."""
    lines = materialized(_fetched(docs, _sieved(distinct)), "sieved-lines")
    links = materialized(_links(materialized(_variants(lines), "variants")), "line-links")
    own = links.join(lines.select("place", "h1", "h2", F.col("words").alias("a")), "place")
    both = own.join(lines.select(F.col("place").alias("earlier"), F.col("words").alias("b")),
                    "earlier")
    return both.filter(one_edit(F.col("a"), F.col("b"))).select("h1", "h2").distinct()


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their texts cut to the kept lines, and line_counts (struct of lines
    and dropped) of each."""
    columns = docs.columns
    docs = _numbered(docs)
    named = materialized(_named_lines(docs, min_words), "named-lines")
    distinct = materialized(_distinct_lines(named), "distinct-lines")
    edited = _edited(docs, distinct).withColumn("edited", F.lit(True))
    # stored, so that the join below can split a line that many places share
    decided = materialized(
        distinct.select("h1", "h2", F.col("place").alias("first"), "times")
        .join(edited, ["h1", "h2"], "left").filter("times > 1 or edited").drop("times"),
        "decided-lines",
    )
    dropped = (
        named.select("doc", "line_no", "place", "h1", "h2").join(decided, ["h1", "h2"])
        .filter(F.col("edited").eqNullSafe(True) | (F.col("place") != F.col("first")))
        .groupBy("doc").agg(F.collect_set(F.struct("line_no", "h1")).alias("_dropped"))
    )
    doc = _doc()
    others = [F.col(c) for c in columns if c != "text"]
    joined = docs.select(*others, "text", doc.alias("_doc")).join(
        dropped.withColumnRenamed("doc", "_doc"), "_doc", "left")
    lines = F.split("text", "\n")
    kept = F.filter(
        F.transform(lines, lambda x, i: F.struct(x.alias("line"), i.alias("i"))),
        # most lines are settled by their number; only named ones are hashed
        lambda s: ~(F.array_contains(F.col("_dropped.line_no"), s["i"]) & F.array_contains(
            F.col("_dropped"),
            F.struct(s["i"].alias("line_no"), F.xxhash64(_plain(s["line"])).alias("h1")))))
    text = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(
        F.concat_ws("\n", F.transform(kept, lambda s: s["line"])))
    return joined.select(
        *[F.col(c) if c != "text" else text.alias("text") for c in columns],
        F.struct(
            F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("lines"),
            F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("dropped"),
        ).alias("line_counts"),
    )
