"""The registered queries as DuckDB SQL over the same tables, to check results against."""

import re

from revlens.fixed_values import (
    ALERT_MESSAGE,
    DEFAULT_SEGMENT_NAMES,
    DEFAULT_TOPIC_NAMES,
    ENGLISH_STOP_WORDS,
    SEGMENT_OTHERWISE,
    SEGMENT_RULES,
    TOPIC_DOMAIN_WORDS,
    TOPIC_SENTIMENT_WORDS,
    TOPIC_THEMES,
)


def _text(value) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(words) -> str:
    return ", ".join(_text(word) for word in words)


def _pairs(pairs) -> str:
    return ", ".join(f"({number}, {_text(name)})" for number, name in pairs)


def _clean(column: str) -> str:
    return (
        rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({column}, '')), "
        rf"'[^a-zA-Z \t\n\x0B\f\r]', '', 'g'), '\bnan\b', '', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g'))"
    )


def _number(column: str, kind: str) -> str:
    parsed = f"try_cast({column} as {kind})"
    return f"case when isnan({parsed}) then null else {parsed} end"


def _clamped(column: str) -> str:
    return f"greatest(1.0, least(5.0, coalesce({_number(column, 'double')}, 3.0)))"


def _label(column: str) -> str:
    return (
        f"case when lower({column}) like '%negative%' then 0 "
        f"when lower({column}) like '%positive%' then 1 else -1 end"
    )


def _name(column: str) -> str:
    return f"case when {column} = 1 then 'Positive' when {column} = 0 then 'Negative' else 'Unknown' end"


CTES = {
    "reviews": """
        select 'review_' || cast(d.doc_id + 1 as varchar) as review_id,
               cast(e.ts as varchar) as "timestamp", d.source as Product, d.lang as Category,
               case when e.event_type = 'error' and e.value < 2 then null
                    when e.event_type = 'error' and e.value < 4 then '' else d.text end as Review,
               coalesce(c.text, case when e.event_type = 'view' then 'NaN' end) as Summary,
               case when e.event_type = 'error' and e.value < 20 then ''
                    when e.event_type = 'error' and e.value < 40 then 'abc'
                    when e.event_type = 'error' and e.value < 60 then 'nan'
                    when e.event_type = 'error' then null
                    else cast(cast(1 + floor(e.value / 15) as bigint) as varchar) end as Rate,
               cast(e.value as varchar) as product_price,
               case when l.quality is null then null
                    when l.quality = 1 and l.toxic = 0 then 'Positive'
                    when l.quality = 0 and l.toxic = 0 then 'neutral'
                    else 'NEGATIVE' end as Sentiment
        from documents d
        left join events e on e.event_id = d.doc_id
        left join conversations c on c.conv_id = d.doc_id and c.turn = 0
        left join labels l on l.doc_id = d.doc_id""",
    "texts": f"""
        select *, cleaned_review || ' ' || cleaned_summary as text_combined
        from (select *, {_clean('Review')} as cleaned_review, {_clean('Summary')} as cleaned_summary,
                     {_label('Sentiment')} as true_label,
                     coalesce({_number('Rate', 'float')}, 0.0)::float as Rate_num,
                     coalesce(length(Review), 0) as review_length,
                     coalesce(length(Summary), 0) as summary_length
              from reviews)""",
    "scoring": "select * from texts where length(text_combined) > 1",
    "training": "select * from scoring where true_label >= 0",
    "annotated": """
        select *,
               case when Rate_num >= 4 then 1.0 when Rate_num > 0 then 0.0
                    else -1.0 end::double as sentiment_pred,
               case when Category = 'es' then -1 when length(text_combined) < 200 then 0
                    when length(text_combined) < 1000 then 1 when length(text_combined) < 3000 then 2
                    when length(text_combined) < 8000 then 3 else 4 end as topic_pred,
               case when Rate_num = 0 then -1 when Category = 'en' then 0 when Category = 'fr' then 1
                    when Category = 'de' then 2 else 3 end as cluster_pred,
               Category || '-' || substr("timestamp", 12, 2) as batch_key
        from scoring""",
    "topic_names": f"select * from (values {_pairs(DEFAULT_TOPIC_NAMES)}) t(id, name)",
    "segment_names": f"select * from (values {_pairs(DEFAULT_SEGMENT_NAMES)}) t(id, name)",
    "docs": f"""
        select a.review_id, a.Product as product, a.Category as category, a.Review as review_text,
               a.Summary as summary, {_clamped('a.Rate')} as rating, a.sentiment_pred as sentiment,
               {_name('a.sentiment_pred')} as sentiment_label, a.topic_pred as topic_id,
               coalesce(t.name, 'Topic ' || a.topic_pred) as topic_name, a.cluster_pred as cluster_id,
               coalesce(s.name, 'Cluster ' || a.cluster_pred) as cluster_name, a."timestamp",
               a.batch_key
        from annotated a
        left join topic_names t on t.id = a.topic_pred
        left join segment_names s on s.id = a.cluster_pred""",
    "report": "select * from docs where review_text is not null and review_text not in ('', 'Unknown')",
    "shares": """
        select batch_key, count(*) as total_reviews,
               count(*) filter (where sentiment = 0) as negative_reviews,
               count(*) filter (where sentiment = 0) / count(*)::double * 100.0 as negative_pct,
               max("timestamp") as last_review
        from docs group by batch_key""",
    "alerts": f"""
        select batch_key as alert_id, 'high_negative' as type,
               printf({_text(ALERT_MESSAGE)}, round_even(negative_pct, 0)) as message,
               last_review as "timestamp",
               case when negative_pct = 100 then 'error' else 'warning' end as level
        from shares where negative_pct > 70""",
    "words": "select *, string_split(rtrim(text_combined), ' ') as tokens from scoring",
    "kept": f"select *, list_filter(tokens, lambda w: w not in ({_list(ENGLISH_STOP_WORDS)})) as kept from words",
    "pairs": """
        select *, [kept[i] || ' ' || kept[i + 1] for i in range(1, len(kept))] as grams from kept""",
    "topic_words": f"""
        select *, list_filter(string_split(text_combined, ' '), lambda w: length(w) >= 3) as long_words,
               list_filter(long_words, lambda w: w not in ({_list(ENGLISH_STOP_WORDS)})
                   and w not in ({_list(TOPIC_SENTIMENT_WORDS)})
                   and w not in ({_list(TOPIC_DOMAIN_WORDS)})) as filtered
        from annotated""",
    "bigram_terms": """
        select term, count(*) as term_count, count(distinct review_id) as doc_count
        from (select review_id, unnest(grams) as term from pairs where true_label >= 0)
        group by term having count(distinct review_id) >= 3
        order by term_count desc, term limit 50000""",
    "topic_terms": """
        select topic, rank, word, weight from (
            select topic_pred as topic, term as word, n::double as weight,
                   row_number() over (partition by topic_pred order by n desc, term) as rank
            from (select topic_pred, term, count(*) as n
                  from (select topic_pred, unnest(filtered) as term from topic_words)
                  group by all))
        where rank <= 10""",
    "turns": f"select role, string_split({_clean('text')}, ' ') as tokens from conversations",
    "learned": f"""
        select role, word from (
            select role, word, row_number() over (partition by role order by n desc, word) as rank
            from (select role, word, count(*) as n
                  from (select role, unnest(tokens) as word from turns)
                  where length(word) >= 3 and word not in ({_list(ENGLISH_STOP_WORDS)})
                    and word not in ({_list(TOPIC_SENTIMENT_WORDS)})
                    and word not in ({_list(TOPIC_DOMAIN_WORDS)})
                  group by all))
        where rank <= 20""",
    "built_in": "select * from (values "
    + ", ".join(
        f"({order}, {_text(theme)}, {_text(word)})"
        for order, (theme, words) in enumerate(TOPIC_THEMES.items(), start=1)
        for word in sorted(set(words))
    )
    + ") t(theme_order, theme, keyword)",
    "themes": """
        select theme_order, theme, keyword from built_in
        union all
        select ascii(role) + 100, upper(role[1]) || role[2:], word from learned""",
    "metrics_rows": """
        select Product, Category, true_label::double as label, sentiment_pred as prediction,
               "timestamp", Rate_num::double as rate, summary_length from annotated
        where true_label >= 0""",
}

# Weighted metrics per group: one row per true class, then averaged by its size.
METRICS = """
    select {keys} sum(hits) / sum(actual)::double as accuracy,
           sum(2.0 * hits / (actual + predicted) * actual) / sum(actual)::double as f1_score,
           sum(case when predicted > 0 then hits / predicted::double else 0 end * actual)
               / sum(actual)::double as precision,
           sum(hits) / sum(actual)::double as recall
    from (select {keys} class, sum(actual) as actual, sum(predicted) as predicted, sum(hits) as hits
          from (select {keys} label as class, 1 as actual, 0 as predicted,
                       (label = prediction)::int as hits from metrics_rows
                union all
                select {keys} prediction, 0, 1, 0 from metrics_rows)
          group by all)
    where actual > 0 {group}"""

CTES["evaluations"] = f"""
        select m.*, a.latest, a.rating, a.summary
        from ({METRICS.format(keys='Product, Category,', group='group by Product, Category')}) m
        join (select Product, Category, max("timestamp") as latest, avg(rate) as rating,
                     avg(summary_length) as summary from metrics_rows group by all) a
        using (Product, Category)"""
CTES["history"] = """
        select replace(latest, ' ', 'T') || 'Z' as training_date,
               substr(replace(latest, ' ', 'T'), 1, 19) as date,
               strftime(latest::timestamp, '%Y-%m-%d %H:%M') as last_trained,
               printf('%.1f%%', round(round(accuracy, 4) * 100.0, 1)) as accuracy,
               printf('%.3f', round(round(f1_score, 4), 3)) as f1_score,
               printf('%.3f', round(round(precision, 4), 3)) as precision,
               printf('%.3f', round(round(recall, 4), 3)) as recall,
               printf('%.3f', round(round(rating / 10.0, 4), 3)) as silhouette,
               case when summary > 0 then printf('%.3f', round(round(-summary, 4), 3)) end
                   as log_perplexity
        from evaluations"""
CTES["features"] = """
        select *, length(text_combined)::double as text_len, sentiment_pred as sentiment_score,
               review_length::double as review_len, summary_length::double as summary_len,
               Rate_num::double as rate_score,
               len(string_split(text_combined, ' '))::double as word_count
        from annotated"""


def _uses(text: str) -> list:
    return [name for name in CTES if re.search(rf"\b(from|join)\s+{name}\b", text)]


def _sql(body: str) -> str:
    """The query after the common tables it uses, directly or through others."""
    ordered = []

    def place(text):
        for name in _uses(text):
            if name not in ordered:
                place(CTES[name])
                ordered.append(name)

    place(body)
    if not ordered:
        return body
    tables = ", ".join(f"{name} as ({CTES[name]})" for name in ordered)
    return f"with {tables} {body}"


def _segment_name(part: int, suffixes) -> str:
    rules = " ".join(
        f"when avg_sentiment {'<' if side == 'below' else '>'} {s} "
        f"and avg_rating {'<' if side == 'below' else '>'} {r} then {_text(texts[part])}"
        for side, s, r, *texts in SEGMENT_RULES
    )
    return (
        f"case {rules} else {_text(SEGMENT_OTHERWISE[part])} end || "
        f"case when avg_length > 200 then {_text(suffixes[0])} "
        f"when avg_length < 50 then {_text(suffixes[1])} else '' end"
    )


SEGMENT_TEXTS = (
    _segment_name(0, (" (Detailed)", " (Brief)")) + " as name, "
    + _segment_name(1, (" - Detailed reviews", " - Brief feedback")) + " as description"
)
SEGMENT_AVERAGES = (
    "avg(sentiment_score) as avg_sentiment, avg(rate_score) as avg_rating, "
    "avg(text_len) as avg_length, count(*) as review_count"
)
PROFILES = f"""
    select cluster_pred as cluster_id, {SEGMENT_TEXTS}, round(avg_sentiment, 2) as avg_sentiment,
           round(avg_rating, 2) as avg_rating, round(avg_length, 0) as avg_length, review_count
    from (select cluster_pred, {SEGMENT_AVERAGES} from features group by cluster_pred)"""

DOCUMENT = """
    select review_id, product, category, review_text, summary, rating, sentiment, sentiment_label,
           to_json({'id': topic_id, 'name': topic_name})::varchar as topic,
           to_json({'id': cluster_id, 'name': cluster_name})::varchar as cluster, "timestamp"
    from docs"""

TOKENS = "select review_id, len({0}) as n_tokens, array_to_string({0}, '|') as tokens from {1}"

DRILLDOWN = "select review_id, product, sentiment_label, rating, review_text from report where "

WINDOWS = """
    select strftime(date_trunc('hour', "timestamp"::timestamp), '%Y-%m-%d %H:%M:%S') as window_start,
           count(*) as total_reviews, count(*) filter (where sentiment = 0) as negative_reviews,
           round(count(*) filter (where sentiment = 0) / count(*)::double * 100.0, 4) as negative_pct,
           count(*) filter (where sentiment = 0) / count(*)::double * 100.0 > 70 as alert
    from docs where {0} group by date_trunc('hour', "timestamp"::timestamp)"""

OVERLAP = """
    select topic, theme_order, theme, count(distinct word) as overlap
    from topic_terms join {0} on word = keyword group by all"""

NAMING = """
    select l.topic, case when coalesce(b.overlap, 0) >= 2 then b.theme
                    else concat_ws(' & ', upper(w1[1]) || w1[2:], upper(w2[1]) || w2[2:]) end as name{1}
    from (select topic, max(word) filter (where rank = 1) as w1,
                 max(word) filter (where rank = 2) as w2 from topic_terms group by topic) l
    left join (select *, row_number() over (partition by topic order by overlap desc, theme_order)
               as place from ({0})) b on b.topic = l.topic and b.place = 1"""

MESSAGE_FIELDS = [
    "review_id", "timestamp", "Product", "Category", "Review", "Summary", "Rate", "product_price"
]

TRAINING_FIELDS = [
    "Product", "Category", "product_price", "Rate", "Review", "Summary", "Sentiment"
]

CENTERS = """
    with dims as (select vec_id, label, unnest(embedding)::double as x,
                         generate_subscripts(embedding, 1) as dim from embeddings),
    sums as (select label, dim, sum(x) as y from dims group by all),
    clusters as (select label, count(distinct vec_id)::double as n, sum(x * x) as p
                 from dims group by label)"""

QUERIES = {
    # sources
    "scan_reviews_csv": "select "
    + ", ".join(f"nullif({c}, '') as {c}" for c in TRAINING_FIELDS) + " from reviews",
    "stage_and_number": "select count(*) as reviews, 1::bigint as first, count(*) as last, count(*) as numbers from reviews",
    "replay_messages": "select json_object("
    + ", ".join(f"'{f}', coalesce(\"{f}\", '')" for f in MESSAGE_FIELDS)
    + ")::varchar as value from reviews",
    "json_decode": "select "
    + ", ".join(f"coalesce(\"{f}\", '') as \"{f}\"" for f in MESSAGE_FIELDS)
    + " from reviews",
    "malformed_messages": "select malformed, count(*) as messages, count(*) filter (where not malformed) as with_id"
    " from reviews cross join (values (true), (false)) t(malformed) group by malformed",
    "interpretation_lookup": f"select cluster_id as id, name from ({PROFILES})",
    # scalar expressions
    "label_sentiment": f"select review_id, {_label('Sentiment')} as sentiment_label from reviews",
    "clean_text": "select review_id, cleaned_review, cleaned_summary from texts",
    "combine_text": "select review_id, text_combined, length(text_combined) as n_chars from texts",
    "text_lengths": "select review_id, review_length::double as review_length, summary_length::double as summary_length from texts",
    "numeric_rating": f"select review_id, Rate, coalesce({_number('Rate', 'float')}, 0.0)::double as rating from reviews",
    "clamp_rating": f"select review_id, Rate, {_clamped('Rate')}::double as rating from reviews",
    "report_rating": f"select review_id, Rate, {_clamped('Rate')}::double as rating from reviews",
    "sanitize_prediction": "select review_id, case when Rate_num in (0, 1) then Rate_num else -1 end::double as sentiment_pred from texts",
    "name_sentiment": f"select review_id, {_name(_label('Sentiment'))} as sentiment_name from reviews",
    "cluster_features": "select review_id, text_len, sentiment_score, review_len, summary_len, rate_score, word_count, "
    + ", ".join(f"0.2::double as topic_{i}" for i in range(5)) + " from features",
    "dominant_topic": "select vec_id, list_position(embedding, list_max(embedding))::int - 1 as topic_pred from embeddings",
    "alert_level": "select alert_id, level from alerts",
    # filters and counts
    "training_rows": "select review_id, true_label as sentiment_label, text_combined, Rate_num::double as Rate_num from training",
    "scoring_rows": "select review_id, 0 as sentiment_label, text_combined from scoring",
    "row_counts": """
        select count(*) as reviews, count(*) filter (where length(text_combined) > 1) as scoring_rows,
               count(*) filter (where true_label >= 0) as labelled_rows,
               count(*) filter (where length(text_combined) > 1 and true_label >= 0) as training_rows
        from texts""",
    "observed_counts": """
        select count(*) as reviews, count(*) filter (where true_label < 0) as unlabelled,
               count(*) filter (where true_label >= 0 and length(text_combined) <= 1) as without_text,
               count(*) filter (where true_label >= 0 and length(text_combined) > 1) as training_rows
        from texts""",
    "scored_by_models": """
        select review_id, product, rating, true as sentiment_known, true as topic_known,
               true as segment_known, c.*
        from docs, (select count(*) as reviews, count(*) filter (where true_label < 0) as unlabelled,
               count(*) filter (where true_label >= 0 and length(text_combined) <= 1) as without_text,
               count(*) filter (where true_label >= 0 and length(text_combined) > 1) as training_rows
               from texts) c""",
    "label_counts": """
        select true_label as sentiment_label, count(*) as reviews,
               round(avg(review_length), 4) as avg_review_length,
               round(avg(summary_length), 4) as avg_summary_length
        from training group by true_label""",
    "reportable_reviews": "select review_id, review_text, rating from report",
    # documents and lookups
    "scored_documents": DOCUMENT,
    "stream_scored": DOCUMENT.replace("review_text, summary,", "coalesce(review_text, '') as review_text, coalesce(summary, '') as summary,"),
    "topic_name_lookup": "select review_id, topic_id as topic_pred, topic_name from docs",
    "segment_name_lookup": "select review_id, cluster_id as cluster_pred, cluster_name from docs",
    "flatten_documents": "select review_id, topic_id, topic_name, cluster_id, cluster_name from docs",
    "flatten_plain_ids": """
        select review_id, topic_id,
               case when topic_id >= 0 then 'Topic ' || topic_id else 'Unknown' end as topic_name,
               cluster_id,
               case when cluster_id >= 0 then 'Cluster ' || cluster_id else 'Unknown' end as cluster_name
        from docs""",
    "document_defaults": """
        select review_id, product, 'Unknown' as category, -1.0::double as sentiment,
               3.0::double as rating, -1 as topic_id, 'Unknown' as topic_name, -1 as cluster_id,
               'Unknown' as cluster_name
        from report""",
    # anomalies and alerts
    "batch_anomaly": """
        select batch_key, total_reviews, negative_reviews, round(negative_pct, 4) as negative_pct, message
        from shares join alerts on alert_id = batch_key""",
    "windowed_anomaly": WINDOWS.format("true"),
    "windowed_anomaly_stream": WINDOWS.format("true"),
    "stream_different": """
        select strftime("timestamp"::timestamp, '%Y-%m-%d') as day,
               count(distinct topic_name) filter (where topic_id >= 0) as topics,
               count(distinct cluster_name) filter (where cluster_id >= 0) as segments
        from docs where "timestamp" is not null group by 1""",
    "stream_alerts": "select alert_id, type, message from alerts",
    "stream_kept_alerts": "select alert_id, type, message from alerts",
    "stored_drilldown": DRILLDOWN
    + "topic_name = 'Price & Value' and topic_id >= 0 and cluster_name = 'Mixed Feedback' and cluster_id >= 0",
    "stream_replayed": "select batch_key, total_reviews, negative_reviews from shares",
    "stream_offsets": """
        select review_id, cast(n % 4 as integer) as queue_partition,
               row_number() over (partition by n % 4 order by n) - 1 as queue_offset, rating,
               sentiment_label
        from (select doc_id + 1 as n, 'review_' || cast(doc_id + 1 as varchar) as review_id
              from documents) left join docs using (review_id)
        qualify sentiment_label is not null""",
    "stream_dedup": "select review_id, product, rating, sentiment_label from docs",
    "recent_alerts": 'select alert_id, type, message, "timestamp", level from alerts order by "timestamp" desc, alert_id desc limit 10',
    "open_alerts": """
        select alert_id, message, "timestamp"
        from (select * from alerts order by "timestamp" desc, alert_id desc limit 3)
        where alert_id not like 'es-%'""",
    # reports
    "kpi_summary": """
        select count(*) as total_reviews, count(*) filter (where sentiment = 1) as positive_reviews,
               count(*) filter (where sentiment = 0) as negative_reviews,
               round(100.0::double * count(*) filter (where sentiment = 1)
                     / count(*) filter (where sentiment in (0, 1)), 4) as positive_pct,
               round(100.0::double * count(*) filter (where sentiment = 0)
                     / count(*) filter (where sentiment in (0, 1)), 4) as negative_pct
        from report""",
    "segment_count": "select count(distinct cluster_id) as segments from report where cluster_id >= 0",
    "sentiment_distribution": "select sentiment_label, count(*) as review_count from report group by all",
    "topic_counts": "select topic_name, count(*) as review_count from report where topic_id >= 0 group by all",
    "top_topics": "select topic_name, count(*) as review_count from report group by all order by 2 desc, 1 limit 5",
    "topic_sentiment_crosstab": """
        select topic_name, count(*) filter (where sentiment = 0) as "Negative",
               count(*) filter (where sentiment = 1) as "Positive",
               count(*) filter (where sentiment = -1) as "Unknown"
        from report where topic_id >= 0 group by topic_name""",
    "topic_summary": """
        select topic_name, count(sentiment) as review_count, round(avg(sentiment), 2) as avg_sentiment,
               round(avg(rating), 2) as avg_rating
        from report where topic_id >= 0 group by topic_name""",
    "distinct_topics": "select distinct topic_name from report where topic_id >= 0",
    "distinct_segments": "select distinct cluster_name from report where cluster_id >= 0",
    "topic_sentiment_breakdown": """
        select topic_name, sentiment_label, count(*) as review_count,
               round(100.0::double * count(*) / sum(count(*)) over (partition by topic_name), 4) as pct
        from report where topic_id >= 0 group by topic_name, sentiment_label""",
    "segment_counts": "select cluster_name, count(*) as review_count from report where cluster_id >= 0 group by all",
    "segment_counts_by_id": "select cluster_id, 'Segment ' || cluster_id as segment, count(*) as review_count from report where cluster_id >= 0 group by all",
    "topic_drilldown": DRILLDOWN + "topic_name = 'Price & Value' and topic_id >= 0",
    "segment_drilldown": DRILLDOWN + "cluster_name = 'Mixed Feedback' and cluster_id >= 0",
    "segment_drilldown_by_id": DRILLDOWN + "cluster_id = 3",
    "recent_reviews": """
        select review_id, "timestamp", product, rating, sentiment_label from docs
        order by "timestamp"::timestamp desc, review_id desc limit 5000""",
    "latest_evaluation": """
        select accuracy, f1_score, precision, recall, silhouette, log_perplexity, last_trained
        from history order by training_date desc limit 1""",
    "training_history": """
        select date, accuracy, f1_score, precision, recall, silhouette, log_perplexity
        from history order by training_date desc limit 10""",
    # text operators
    "tokenize": TOKENS.format("tokens", "words"),
    "remove_stopwords": TOKENS.format("kept", "kept"),
    "bigrams": TOKENS.format("grams", "pairs"),
    "tokenize_regex": TOKENS.format("long_words", "topic_words"),
    "remove_topic_stopwords": TOKENS.format("filtered", "topic_words"),
    "vocabulary": "select term, term_count, doc_count from bigram_terms",
    "idf_weights": """
        select term, doc_count,
               round(ln(((select count(*) from training) + 1.0) / (doc_count + 1.0)), 6) as idf
        from bigram_terms""",
    "topic_vocabulary": """
        select term, count(*) as term_count, count(distinct review_id) as doc_count
        from (select review_id, unnest(filtered) as term from topic_words where true_label >= 0)
        group by term
        having count(distinct review_id) >= 5
           and count(distinct review_id) <= 0.8 * (select count(*) from training)
        order by term_count desc, term limit 5000""",
    "standardize": "select review_id, "
    + ", ".join(
        f"round(coalesce(({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0), 0), 4) as scaled_{c}"
        for c in ("Rate_num", "review_length", "summary_length")
    )
    + " from training",
    # quality
    "classifier_metrics": "select round(accuracy, 6) as accuracy, round(f1_score, 6) as f1_score, "
    "round(precision, 6) as precision, round(recall, 6) as recall from ("
    + METRICS.format(keys="", group="") + ")",
    "silhouette": CENTERS + """,
        norms as (select vec_id, label, sum(x * x) as norm from dims group by all),
        distances as (
            select d.vec_id, n.label as own, s.label as other, any_value(c.n) as size,
                   any_value(n.norm) + any_value(c.p) / any_value(c.n)
                   - 2 * sum(d.x * s.y) / any_value(c.n) as mean
            from dims d join sums s on s.dim = d.dim join clusters c on c.label = s.label
            join norms n on n.vec_id = d.vec_id
            group by d.vec_id, n.label, s.label),
        scored as (
            select vec_id, max(mean * size / (size - 1)) filter (where own = other) as a,
                   min(mean) filter (where own <> other) as b
            from distances group by vec_id)
        select round(avg(case when a < b then 1 - a / b when a > b then b / a - 1 else 0 end), 6)
                   as silhouette, count(*) as points
        from scored""",
    "kmeans_assign": CENTERS + """,
        distances as (
            select d.vec_id, d.label, s.label as center, sum((d.x - s.y / c.n) ** 2) as distance
            from dims d join sums s on s.dim = d.dim join clusters c on c.label = s.label
            group by all)
        select vec_id, label, arg_min(center, (distance, center)) as nearest
        from distances group by vec_id, label""",
    # topics and segments
    "topic_words": "select topic, rank::int as rank, word, weight from topic_terms",
    "topic_theme_overlap": f"select topic, theme, overlap from ({OVERLAP.format('themes')})",
    "topic_naming": NAMING.format(OVERLAP.format("themes"), ", coalesce(b.overlap, 0) as overlap"),
    "topic_naming_fallback": NAMING.format(OVERLAP.format("built_in"), ""),
    "cluster_profile": PROFILES,
    "segment_naming": f"""
        select product, category, sentiment, {SEGMENT_TEXTS}
        from (select Product as product, Category as category, sentiment_pred as sentiment,
                     {SEGMENT_AVERAGES} from features group by all)""",
}


def _page() -> str:
    """The report page: the numbers of six reports in one column."""
    keys = {"topic_counts": "topic_name", "topic_sentiment_crosstab": "topic_name",
            "topic_summary": "topic_name", "sentiment_distribution": "sentiment_label",
            "segment_counts": "cluster_name", "kpi_summary": "''"}
    numbers = {
        "kpi_summary": ["total_reviews", "positive_reviews", "negative_reviews", "positive_pct",
                        "negative_pct"],
        "topic_sentiment_crosstab": ["Negative", "Positive", "Unknown"],
        "topic_summary": ["review_count", "avg_sentiment", "avg_rating"]}
    return " union all ".join(
        f"select '{name}' as report, {key} as item, '{number}' as number, "
        f'cast("{number}" as double) as value from ({QUERIES[name]})'
        for name, key in keys.items() for number in numbers.get(name, ["review_count"]))


QUERIES["report_page"] = _page()


def oracle_sql() -> dict:
    return {name: _sql(body) for name, body in QUERIES.items()}
