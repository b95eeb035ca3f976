"""The registered queries as plain SQL over the same tables, for checking results with another engine."""

from __future__ import annotations

from topicwake.functions.stopwords import STOP_WORDS
from topicwake.plans.queries import ELIGIBLE_TYPES, EVENT_TYPES, NOISE_AFTER, NOISE_BEFORE, USER_WINDOW, WINDOW

_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
# The normaliser's rules and their order.
_MONTHS = (
    "january|february|march|april|may|june|july|august|september|october|november|december|"
    "jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec"
)
_RULES = [
    (r"https?://\S+", ""),
    (r"\S+@\S+", ""),
    (r"<[^>]+>", ""),
    (r"\b\d{1,2}:\d{2}:\d{2}\s*(am|pm)?\b", ""),
    (rf"\b({_MONTHS})\s+\d{{1,2}}(,\s*\d{{4}})?\b", ""),
    (r"\[\s*\d+\s*\]", ""),
    ("[^a-z0-9]", " "),
    ("[0-9]+", ""),
]


def _normalized(text: str) -> str:
    sql = f"nfc_normalize(lower({text}))"
    for pattern, by in _RULES:
        sql = f"regexp_replace({sql}, '{pattern}', '{by}', 'g')"
    words = f"list_filter(string_split({sql}, ' '), lambda w: w <> '' and not list_contains({_STOP}, w))"
    return f"array_to_string({words}, ' ')"


def _words(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda w: length(w) >= 2 and not list_contains({_STOP}, w))"


_RAW = """raw as (
  select d.doc_id id, split_part(d.text, chr(10), 1) title, d.text, coalesce(cast(l.quality as double), 0.0) score,
    case when l.quality is null then '[]' else concat('[', l.quality, ', ', l.toxic, ']') end reddit_scores
  from documents d left join labels l using (doc_id))"""

_CLEAN = f"""clean as (
  select doc_id id, {_normalized('text')} as text, cast(length(text) as integer) original_length from documents),
lens as (select id, text, original_length, cast(length(text) as integer) normalized_length from clean)"""

_TOKENS = f"""clean as (select doc_id id, lang, {_normalized('text')} as text from documents),
toks as (select id, lang, {_words('text')} as tokens from clean),
words as (select id, lang, unnest(tokens) term from toks)"""

_VOCABULARY = f"""{_TOKENS},
tally as (select term, cast(count(*) as bigint) tf, cast(count(distinct id) as bigint) df from words group by term),
kept as (select * from tally where df >= 2 and df <= 0.95 * (select count(*) from documents)
  order by tf desc, term limit 5000),
vocab as (select term, cast(row_number() over (order by term) - 1 as integer) idx, tf, df from kept)"""


def _events(types: list[str]) -> str:
    place = "case event_type " + " ".join(f"when '{t}' then {i}" for i, t in enumerate(types)) + " else -1 end"
    return f"""t as (select event_id id, event_type, value, props, {place} as topic from events),
b as (select *, cast(coalesce(sum(case when topic >= 0 then 1 else 0 end)
  over (order by id rows between unbounded preceding and 1 preceding), 0) as bigint) e from t),
r as (select *, e // {WINDOW} as window_id, topic >= 0 and e % {WINDOW} = {WINDOW - 1} as is_closing from b),
h as (select window_id, topic, count(*) c from r where topic >= 0 group by all),
n as (select window_id, sum(c) n from h group by window_id having sum(c) = {WINDOW}),
g as (select window_id, n, unnest(range(10)) topic from n),
p as (select g.window_id, cast(g.topic as integer) topic, (coalesce(h.c, 0) + 1e-10) / (g.n + 10 * 1e-10) p
  from g left join h on h.window_id = g.window_id and h.topic = g.topic),
j as (select x.window_id, sqrt(greatest(0, sum(y.p * ln(y.p / ((x.p + y.p) / 2)) + x.p * ln(x.p / ((x.p + y.p) / 2))) / 2)) js
  from p x join p y on y.window_id = x.window_id - 1 and y.topic = x.topic group by x.window_id),
w as (select n.window_id, coalesce(js, 0.0) js from n left join j using (window_id)),
dw as (select window_id, round(js, 4) js_divergence, js > 0.15 drift_detected,
  case when js < 0.05 then 'none' when js < 0.10 then 'low' when js < 0.20 then 'medium' else 'high' end drift_magnitude
  from w)"""


_DRIFT = _events(ELIGIBLE_TYPES)
_FEATURES = f"""{_DRIFT},
feat as (select r.id, r.props as text, r.event_type title, r.value score,
  cast(floor(value * 10) as integer) original_length, cast(floor(value * 6) as integer) normalized_length,
  'sklearn-lda-v1' model_version, cast(r.topic as integer) dominant_topic,
  case r.topic when 0 then '1.0|0.0|0.0|0.0' when 1 then '0.0|1.0|0.0|0.0' when 2 then '0.0|0.0|1.0|0.0'
    when 3 then '0.0|0.0|0.0|1.0' else '' end topic_distribution,
  case when r.topic >= 0 then event_type else '' end top_words, r.window_id,
  coalesce(dw.drift_detected, false) drift_detected, coalesce(dw.js_divergence, 0.0) js_divergence,
  coalesce(dw.drift_magnitude, 'none') drift_magnitude
  from r left join dw on r.window_id = dw.window_id and r.is_closing)"""

_SPARSE = f"""with {_DRIFT} select id, case when topic >= 0 then event_type else '' end title,
  case when topic >= 0 then props else '' end as text, case when topic >= 0 then value else 0.0 end score,
  case when topic >= 0 then cast(floor(value * 10) as integer) else 0 end original_length,
  case when topic >= 0 then cast(floor(value * 6) as integer) else 0 end normalized_length,
  'sklearn-lda-v1' model_version, cast(topic as integer) dominant_topic, '' as topic_distribution,
  case when topic >= 0 then event_type else '' end top_words, case when topic >= 0 then id else 0 end window_id,
  topic >= 0 as drift_detected, cast(0.0 as double) js_divergence, 'none' as drift_magnitude from t"""

_TOPIC_COLUMNS = ", ".join(
    f"round(count(*) filter (where dominant_topic = {t}) / count(*), 6) as topic_{'none' if t < 0 else t}"
    for t in (-1, 0, 1, 2, 3)
)

ORACLES: dict[str, str] = {
    "scan_defaults": f"with {_RAW} select * from raw",
    "scan_numbered": "select doc_id id, doc_id, lang from documents",
    "limit_ingest": "select event_id id, event_id, event_type from events order by event_id limit 1000",
    "dense_id": "select row_number() over (order by conv_id, turn) - 1 as id, conv_id, turn from conversations",
    "skip_landed": "select doc_id, source from documents where doc_id not in (select doc_id from labels)",
    "normalize_docs": f"""with {_RAW},
noisy as (select id, title, concat('{NOISE_BEFORE}', text, '{NOISE_AFTER}') as text, score, reddit_scores from raw),
norm as (select id, {_normalized('title')} as title, {_normalized('text')} as text,
  cast(length(text) as integer) original_length, score, reddit_scores from noisy)
select *, cast(length(text) as integer) normalized_length from norm""",
    "normalize_pages": f"""with n as (select page_id, {_normalized('html')} as text from pages)
select page_id, text, cast(length(text) as integer) text_length from n""",
    "tokenize": f"""with {_TOKENS}
select id, array_to_string(tokens, ' ') tokens, cast(len(tokens) as integer) n_tokens from toks""",
    "vocabulary": f"with {_VOCABULARY} select term, idx, tf, df from vocab",
    "doc_term_counts": f"""with {_VOCABULARY}
select id, term, cast(count(*) as bigint) n from words join vocab using (term) group by id, term""",
    "top_words": f"""with {_TOKENS},
ranked as (select lang topic, term, cast(row_number() over (partition by lang order by count(*) desc, term) as integer) rank
  from words group by lang, term)
select topic, rank, term from ranked where rank <= 10""",
    "dominant_topic": "select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as integer) topic from embeddings",
    "attach_top_words": f"""with {_DRIFT},
words as (select topic, concat(min(event_type), '|', max(props)) words from t where topic >= 0 group by topic)
select id, cast(t.topic as integer) dominant_topic, coalesce(words, '') top_words from t left join words using (topic)""",
    "unfitted_scores": "select doc_id id, -1 as dominant_topic, '' as topic_distribution, '' as top_words from documents",
    "count_windows": f"with {_DRIFT} select id, window_id, is_closing from r",
    "window_histogram": f"with {_DRIFT} select window_id, topic, round(p, 6) p from p",
    "adjacent_windows": f"""with {_DRIFT} select x.window_id, x.topic, round(x.p, 6) p, round(y.p, 6) previous_p
from p x join p y on y.window_id = x.window_id - 1 and y.topic = x.topic""",
    "js_distance": """with v as (select vec_id, unnest(range(len(embedding))) k,
  unnest(list_transform(embedding, lambda x: abs(cast(x as double)))) a from embeddings),
s as (select vec_id, k, a / sum(a) over (partition by vec_id) p from v)
select x.vec_id, round(sqrt(greatest(0, sum(
  case when x.p > 0 then x.p * ln(x.p / ((x.p + y.p) / 2)) else 0 end
  + case when y.p > 0 then y.p * ln(y.p / ((x.p + y.p) / 2)) else 0 end) / 2)), 6) js
from s x join s y on y.vec_id = x.vec_id - 1 and y.k = x.k group by x.vec_id""",
    "drift_windows": f"with {_DRIFT} select * from dw",
    "drift_windows_all": f"with {_events(EVENT_TYPES)} select * from dw",
    "drift_rows_output": f"""with {_FEATURES}
select id, window_id, js_divergence, drift_detected, drift_magnitude from feat""",
    "drift_summary": f"""with {_DRIFT},
last as (select * from dw where drift_detected order by window_id desc limit 10)
select count(*) total_windows, count(*) filter (where drift_detected) drift_events_count,
  coalesce((select string_agg(concat(window_id, ' ', js_divergence, ' ', drift_magnitude, ' 2024-01-02T03:04:05.000000'), '|'
    order by window_id) from last), '') drift_events from dw""",
    "last_drift_events": f"""with {_DRIFT} select window_id, js_divergence, drift_magnitude as magnitude,
  '2024-01-02T03:04:05.000000' as timestamp from dw where drift_detected order by window_id desc limit 10""",
    "run_modeling": "select doc_id id, true as sums_to_one, true as first_largest, cast(10 as integer) n_words from documents",
    "topics_summary": """select cast(topic_id as integer) topic_id, cast(10 as bigint) n_words, cast(10 as bigint) n_known
from (select unnest(range(10)) topic_id)""",
    "lda_partial_fit": f"""with {_TOKENS},
places as (select doc_id id, (row_number() over (order by doc_id) - 1) // (((select count(*) from documents) + 2) // 3) part from documents),
tally as (select term, count(*) tf, count(distinct id) df from words join places using (id) where part = 0 group by term),
kept as (select term from tally where df >= 2 and df <= 0.95 * (select count(*) from places where part = 0)
  order by tf desc, term limit 5000)
select term, count(*) mass from words join places using (id) join kept using (term) where part = 2 group by term""",
    "analyse_documents": f"""select doc_id id, cast((row_number() over (order by doc_id) - 1) // {WINDOW} as bigint) window_id,
  coalesce(cast(quality as double), 0.0) score, cast(length(text) as integer) original_length, true as sums_to_one, true as first_largest,
  cast(10 as integer) n_words from documents left join labels using (doc_id)""",
    "stream_topics": "select doc_id id, true as sums_to_one, true as first_largest, cast(10 as integer) n_words from documents",
    "quarantine": """with c as (select conv_id, (conv_id * 100 + turn) % 7 = 0 as broken from conversations)
select count(*) filter (where not broken) good, cast(sum(conv_id) filter (where not broken) as bigint) sum_of_ids,
  count(*) filter (where broken) bad from c""",
    "load_stage": "select doc_id, lang, true as filled from documents",
    "dead_letters": r"""with c as (select conv_id * 100 + turn as place, turn, case when (conv_id * 100 + turn) % 13 = 0 then ' ' else text end as text
  from conversations),
w as (select *, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') as words,
  case when place % 7 = 0 then 'decode' when place % 11 = 0 then 'cast' when place % 13 = 0 then 'score' end as step from c)
select place, case when step is null then cast(turn as double) end as score,
  case when step is null then round(list_sum(list_transform(words, lambda x: length(x))) / len(words), 6) end as mean_word, step,
  case step when 'decode' then 'no JSON object of the stage' when 'cast' then concat('score is no double: x', turn)
    when 'score' then 'ZeroDivisionError: division by zero' end as reason from w""",
    "file_inventory": """select count(*) n_rows, min(doc_id) least_id, max(doc_id) greatest_id, cast(0 as bigint) opened_again
from documents""",
    "stream_ingest": """select row_number() over (order by doc_id) - 1 as id, '' as title, coalesce(text, 'None') as text,
  cast(0.0 as double) score, '[]' as reddit_scores from documents""",
    "stream_drift": f"with {_DRIFT} select * from dw",
    "stream_normalize": f"with {_CLEAN} select id, text, original_length, normalized_length from lens",
    "modeled_record": _SPARSE,
    "stream_sink": _SPARSE,
    "write_stages": f"""with {_FEATURES}, bt as (select id, normalized_length,
  (row_number() over (order by id) - 1) // 100 + 1 as batch_num from feat)
select batch_num, cast(sum(normalized_length) as bigint) chars, '20240102_030405' as timestamp, count(*) record_count,
  min(id) id_range_min, max(id) id_range_max from bt group by batch_num""",
    "split_raw": f"with {_RAW} select id, title, text, score, reddit_scores from raw",
    "split_processed": f"with {_FEATURES} select id, text, original_length, normalized_length, score from feat",
    "split_features": f"with {_FEATURES} select * from feat",
    "batch_manifest": """with b as (select doc_id, (row_number() over (order by doc_id) - 1) // 100 + 1 as batch_num from documents)
select batch_num, '20240102_030405' as timestamp, count(*) record_count, min(doc_id) id_range_min, max(doc_id) id_range_max,
  printf('batch_%06d_20240102_030405', batch_num) batch_name from b group by batch_num""",
    "overview": f"""with {_FEATURES} select count(*) records, round(avg(original_length), 6) avg_original_length,
  round(avg(normalized_length), 6) avg_normalized_length, arg_min(model_version, id) model_version,
  count(distinct dominant_topic) topics_detected,
  count(distinct case when drift_detected then window_id end) drift_windows,
  count(distinct window_id) windows from feat""",
    "normalization_impact": f"""with {_CLEAN} select round(avg(case when original_length > 0 then
  cast(original_length - normalized_length as double) / original_length * 100 end), 6) avg_reduction_pct,
  cast(sum(original_length) - sum(normalized_length) as bigint) chars_saved from lens""",
    "lengths_long": f"""with {_CLEAN} select 'Original' as type, cast(original_length as bigint) as length from lens
union all select 'Normalized', cast(normalized_length as bigint) from lens""",
    "length_boxplot": f"""with {_CLEAN}, l as (select 'Original' as type, original_length as n from lens
union all select 'Normalized', normalized_length from lens)
select type, cast(min(n) as double) min_len, cast(quantile_cont(n, 0.25) as double) q1,
  cast(quantile_cont(n, 0.5) as double) median, cast(quantile_cont(n, 0.75) as double) q3,
  cast(max(n) as double) max_len from l group by type""",
    "docs_per_topic": f"""with {_FEATURES} select concat('Topic ', dominant_topic) topic, count(*) docs from feat
group by dominant_topic""",
    "topic_words_first": f"""with {_FEATURES} select dominant_topic topic, arg_min(top_words, id) words from feat
where dominant_topic >= 0 and top_words <> '' group by dominant_topic""",
    "topic_heatmap": """with f as (select * from embeddings order by vec_id limit 50),
u as (select vec_id id, unnest(range(len(embedding))) topic, unnest(embedding) p from f)
select id, cast(topic as integer) topic, round(cast(p as double), 6) probability from u""",
    "window_topic_share": f"""with {_FEATURES}, k as (select distinct dominant_topic topic from feat),
s as (select window_id, count(*) n from feat group by window_id)
select s.window_id, cast(k.topic as integer) topic,
  round((select count(*) from feat f where f.window_id = s.window_id and f.dominant_topic = k.topic) / s.n, 6) as share
from s cross join k""",
    "window_topic_table": f"with {_FEATURES} select window_id, {_TOPIC_COLUMNS} from feat group by window_id",
    "window_stats_first": f"""with {_FEATURES} select window_id, arg_min(js_divergence, id) js_divergence,
  arg_min(drift_detected, id) drift_detected, arg_min(drift_magnitude, id) drift_magnitude from feat group by window_id""",
    "window_stats": f"""with {_FEATURES}, l as (select window_id, max(id) id from feat where dominant_topic >= 0 group by 1)
select w.window_id, f.js_divergence, f.drift_detected, f.drift_magnitude
from (select distinct window_id from feat) w left join l using (window_id) left join feat f on f.id = l.id""",
    "avg_js": f"""with {_FEATURES}, s as (select window_id, arg_min(js_divergence, id) a,
  arg_max(js_divergence, case when dominant_topic >= 0 then id end) z from feat group by window_id)
select round(avg(a), 6) avg_js, round(avg(z), 6) avg_js_closing from s""",
    "drift_rows": f"""with {_FEATURES} select id, window_id, js_divergence, drift_magnitude from feat
where drift_detected""",
    "drift_event_log": f"""with {_FEATURES} select window_id, arg_min(js_divergence, id) js_divergence,
  arg_min(drift_magnitude, id) drift_magnitude from feat where drift_detected group by window_id""",
    "sample_n": "select doc_id, lang, n_chars from documents order by md5(concat(doc_id, '-42')), doc_id limit 100",
    "page": """select doc_id id, case when length(text) > 500 then concat(substr(text, 1, 500), '...') else text end snippet
from documents order by doc_id limit 10 offset 20""",
    "page_count": """select count(*) as rows, cast(greatest(1, ceil(count(*) / 10)) as bigint) total_pages from documents""",
}
ORACLES["overview_merged"] = ORACLES["overview"]
ORACLES["lengths_merged"] = f"""with {_FEATURES}, l as (select 'Original' as type, original_length as n from feat
union all select 'Normalized', normalized_length from feat)
select type, count(*) n, cast(min(n) as bigint) min_len, cast(max(n) as bigint) max_len, true as close from l group by type"""
ORACLES["stream_drift_by_key"] = f"""with t as (select event_id id, user_id, list_position({ELIGIBLE_TYPES}, event_type) - 1 as topic from events),
r as (select *, (row_number() over (partition by user_id order by id) - 1) // {USER_WINDOW} as window_id from t where topic >= 0),
n as (select user_id, window_id, max(id) closing_id from r group by all having count(*) = {USER_WINDOW}),
g as (select *, unnest(range(10)) topic from n),
p as (select g.*, (count(r.id) + 1e-10) / ({USER_WINDOW} + 10 * 1e-10) p
  from g left join r using (user_id, window_id, topic) group by all),
j as (select x.user_id, x.window_id, sqrt(greatest(0, sum(y.p * ln(y.p / ((x.p + y.p) / 2)) + x.p * ln(x.p / ((x.p + y.p) / 2))) / 2)) js
  from p x join p y on y.user_id = x.user_id and y.window_id = x.window_id - 1 and y.topic = x.topic group by all),
w as (select n.*, coalesce(js, 0.0) js from n left join j using (user_id, window_id))
select user_id, window_id, closing_id, round(js, 4) js_divergence, js > 0.15 drift_detected,
  case when js < 0.05 then 'none' when js < 0.10 then 'low' when js < 0.20 then 'medium' else 'high' end drift_magnitude from w"""
ORACLES["scan_corpus"] = """select row_number() over (order by doc_id % 3, doc_id) - 1 as id,
  case doc_id % 3 when 0 then 'a' when 1 then '' else 'c' end as title, coalesce(text, 'None') as text,
  cast(doc_id % 2048 as double) / 8 score, '[]' as reddit_scores from documents"""
ORACLES["land_files"] = "select doc_id, lang, true as once from documents"
ORACLES["stage_round_trip"] = "select doc_id, text, lang, n_chars from documents"
ORACLES["normalize_compatible"] = f"""with t as (select doc_id, concat('fishing House office 12 otel ', text) as text from documents)
select doc_id, {_normalized('text')} as text from t"""
ORACLES["fit_failure"] = """select doc_id id, -1 as dominant_topic, '' as topic_distribution, '' as top_words,
  'No terms remain in the vocabulary' as error, false as has_summary from documents"""
ORACLES["stream_replay"] = _SPARSE
