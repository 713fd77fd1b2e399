"""The same results in SQL, written for another engine and from the tables alone."""

from __future__ import annotations

# The English stop list that the text reports use.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll "
    "they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't "
    "wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's "
    "there's what's when's where's who's why's would"
).split()
STOP_SQL = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)

BLANK = (
    r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
NOT_WORD = (
    r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
    r"\x{205F}\x{3000}]"
)
TERM = r"[\p{L}\p{N}_]{2,}"

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
def _key_text(*names: str) -> str:
    """Length-marked key text of several columns that are never null."""
    return "concat_ws('|', " + ", ".join(f"length({n}::varchar) || ':' || {n}" for n in names) + ")"


KEY_TEXT = _key_text(*KEY.split(", "))

NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
]
POINTS = f"points as (select {KEY}, l_quantity as px, l_extendedprice / 1000 as py from lineitem)"
RATINGS = (
    "ratings as (select user_id::int as userId, json_extract_string(props, '$.k')::int as movieId, "
    "least(5.0, greatest(1.0, round(value / 10 + 1)))::double as rating from events)"
)
RATING_EVENTS = """e as (select event_id, user_id::int as userId, json_extract_string(props, '$.k')::int as movieId,
  round(value / 10 + 1)::double as rating from events)"""
RECORDS = """records as (select l_discount as duration, l_returnflag as protocol_type,
  's' || (l_suppkey % 20)::varchar as service, l_linestatus as flag,
  l_extendedprice as src_bytes, l_quantity as dst_bytes,
  case when l_quantity > 40 then 'bulk.' when l_discount > 0.08 then 'promo.'
    else 'normal.' end as label from lineitem)"""
LABELLED = f"""{RECORDS}, labelled as (select *,
  case when label = 'normal.' then 'normal' else 'attack' end as new_label from records)"""
RECORD_TEXT = _key_text("duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "label", "new_label").replace(
    "|| duration", "|| duration::varchar"
)
COMMENTS = """comments as (select d.doc_id, d.text as "CONTENT", l.toxic::double as "CLASS"
  from documents d left join labels l using (doc_id))"""
CLEANED = (
    "regexp_replace(regexp_replace(regexp_replace(lower(\"CONTENT\"), '\\p{Nd}+', '', 'g'), "
    f"'{BLANK}+', ' ', 'g'), '{NOT_WORD}', '', 'g')"
)
WORDS = """words as (select unnest(regexp_split_to_array(text, '[\\t-\\r\\x20]+')) as word
  from documents), counts as (select word, count(*) as count from words where word <> '' group by 1)"""
PAIRS = """pairs as (select l.toxic as label, case when d.n_chars % {n} = 0 then 1 else 0 end
  as prediction from labels l join documents d using (doc_id))"""


def _terms(content: str, stop: bool) -> str:
    listed = f"where term not in ({STOP_SQL})" if stop else ""
    return f"""{COMMENTS}, terms as (select doc_id, "CLASS", term from (select doc_id, "CLASS",
      unnest(regexp_extract_all(lower({content}), '{TERM}')) as term from comments) {listed})"""


def _tfidf(content: str, size: int, stop: bool) -> str:
    """Term weights, cell by cell."""
    return f"""{_terms(content, stop)},
    vocabulary as (select term from terms group by term order by count(*) desc, term limit {size}),
    tf as (select doc_id, any_value("CLASS") as "CLASS", term, count(*) as tf
      from terms semi join vocabulary using (term) group by doc_id, term),
    df as (select term, count(*) as df from tf group by term),
    raw as (select doc_id, "CLASS", term,
      tf * (ln((1 + (select count(*) from comments)) / (1 + df)::double) + 1) as w
      from tf join df using (term)),
    weights as (select doc_id, "CLASS", term,
      w / sqrt(sum(w * w) over (partition by doc_id)) as weight from raw)"""


def _kmeans(steps: int, k: int = 5) -> str:
    """Seeds as c0, then per step the nearest centroid, lowest id on a tie, and its mean."""
    parts = [
        POINTS,
        f"""c0 as materialized (select row_number() over (order by {KEY}) - 1 as cid, px as cx,
          py as cy, 0::bigint as size from (select * from points order by {KEY} limit {k}))""",
    ]
    for step in range(1, steps + 1):
        parts.append(
            f"""c{step} as materialized (select cid, avg(px) as cx, avg(py) as cy, count(*) as size
            from (select px, py, (select struct_extract(min({{'d': (px - cx) * (px - cx)
              + (py - cy) * (py - cy), 'cid': cid}}), 'cid') from c{step - 1}) as cid from points)
            group by cid)"""
        )
    return "with " + ",\n".join(parts)


def _assigned(k: int = 5) -> str:
    return f"""{_kmeans(0, k)}, assigned as (select {KEY}, px, py,
      (select struct_extract(min({{'d': (px - cx) * (px - cx) + (py - cy) * (py - cy),
      'cid': cid}}), 'cid') from c0) as cid from points)"""


WIDE = """with seeds as (select vec_id::int as cid, unnest(embedding)::double as c,
    generate_subscripts(embedding, 1) as i from embeddings
    where vec_id in (select vec_id from embeddings order by vec_id limit 8)),
  ids as (select cid, row_number() over (order by cid) - 1 as place from (select distinct cid from seeds)),
  cells as (select vec_id, unnest(embedding)::double as x,
    generate_subscripts(embedding, 1) as i from embeddings),
  distances as (select vec_id, cid, sum((x - c) * (x - c)) as d
    from cells join seeds using (i) group by all),
  assigned as (select vec_id, arg_min(place, (d, place))::int as cid
    from distances join ids using (cid) group by vec_id)"""

REPORT = PAIRS.format(n=3) + """,
  classes as (select distinct label as class from pairs
    union select distinct prediction from pairs),
  scores as (select class,
    (select count(*) from pairs where label = class and prediction = class) as hits,
    (select count(*) from pairs where label = class) as support,
    (select count(*) from pairs where prediction = class) as predicted from classes),
  report as (select class, support, hits,
    case when predicted = 0 then 0 else hits / predicted end as "precision",
    case when support = 0 then 0 else hits / support end as recall,
    case when support + predicted = 0 then 0 else 2 * hits / (support + predicted) end as f1
    from scores)"""


def _confusion(n: int, name: str = "pairs") -> str:
    return f"""{PAIRS.format(n=n).replace("pairs as", name + " as")},
  {name}_classes as (select distinct label as class from {name}
    union select distinct prediction from {name}),
  {name}_cells as (select a.class as label, b.class as prediction,
    (select count(*) from {name} p where p.label = a.class and p.prediction = b.class) as count
    from {name}_classes a, {name}_classes b)"""


def _model_rows(name: str, table: str) -> str:
    return f"""select '{name}' as model, 'accuracy' as measure, null::varchar as label,
    null::varchar as prediction, round(avg((label = prediction)::int), 6) as value from {table}
  union all select '{name}', 'count', label::varchar, prediction::varchar, count::double
    from {table}_cells"""


SPLIT = "('0x' || substr(md5(" + _key_text("userId", "movieId") + "), 1, 8))::bigint / 4294967296.0"
TRAIN_TEST = f"""{RATINGS}, means as (select userId, movieId, avg(rating) as rating from ratings
    group by 1, 2),
  train as (select * from means where {SPLIT} < 0.8),
  test as (select * from means where {SPLIT} >= 0.8)"""
SCORED = f"""with {TRAIN_TEST} select userId, movieId, true as scored from test
  where userId in (select userId from train) and movieId in (select movieId from train)"""


def _describe(column: str) -> str:
    return f"""select '{column}' as "column", count({column}) as count,
    round(avg({column}), 6) as mean, round(stddev_samp({column}), 6) as stddev,
    min({column})::double as min, max({column})::double as max,
    null::varchar as min_text, null::varchar as max_text from ratings"""


def _percentiles(column: str) -> str:
    quartiles = ", ".join(
        f"round(quantile_cont({column}, {share}), 6) as p{name}"
        for name, share in (("25", 0.25), ("50", 0.5), ("75", 0.75))
    )
    return f"""select '{column}' as "column", count({column}) as count,
    round(avg({column}), 6) as mean, round(stddev_samp({column}), 6) as std,
    min({column}) as min, {quartiles}, max({column}) as max from lineitem"""


def _profile(column: str, kind: str, present: str) -> str:
    return f"""select '{column}' as "column", '{kind}' as type, count(*) as rows,
    {present} as non_null from comments"""


def _index(column: str) -> str:
    return f"""select '{column}' as "column", {column} as category,
    (row_number() over (order by count(*) desc, {column}) - 1)::double as place,
    count(*) as count from labelled group by {column}"""


def _place(column: str) -> str:
    return f"""(select {column}, (row_number() over (order by count(*) desc, {column}) - 1)::double
    as {column}_place from labelled group by {column}) using ({column})"""


def _count_by(column: str) -> str:
    return f"with {RECORDS} select {column}, count(*) as count from records group by 1"


ORACLES: dict[str, str] = {
    "read_lines_gzip": "select unnest(string_split(text, chr(10))) as value from documents",
    "read_table_csv_ratings": f"with {RATINGS} select * from ratings",
    "read_table_csv_comments": f"with {COMMENTS} select * from comments",
    "read_checked_csv_rows": f"""with {RATING_EVENTS} select userId, movieId, rating from e
      where not (event_id >= 500 and event_id % 50 < 3)""",
    "read_checked_csv_malformed": f"""with {RATING_EVENTS} select case event_id % 50
        when 0 then userId || ',n/a,' || rating when 1 then userId || ',' || movieId
        else userId || ',' || movieId || ',' || rating || ',more' end as value from e
      where event_id >= 500 and event_id % 50 < 3""",
    "read_positional_fields": f"""with {RECORDS} select duration::varchar as duration, protocol_type,
      service, flag, src_bytes::varchar as src_bytes, dst_bytes::varchar as dst_bytes, label
      from records""",
    "read_points_planar": f"with {POINTS} select {KEY}, round(px, 6) as cx, round(py, 6) as cy "
    "from points",
    "read_seeds_file": f"{_kmeans(0)} select cid::int as cid, round(cx, 6) as cx, "
    "round(cy, 6) as cy from c0",
    "read_centroids_file": f"{_kmeans(1)} select cid::int as cid, round(cx, 6) as cx, "
    "round(cy, 6) as cy from c1",
    "write_kv_words": f"with {WORDS} select word || chr(9) || count::varchar as value from counts",
    "preview": "select doc_id, lang, n_chars from documents order by doc_id limit 10",
    "split_fields": """select c_mktsegment || ' ' || c_acctbal::varchar as value,
      c_mktsegment as department, round(c_acctbal::float::double, 4) as salary from customer""",
    "field_count": "select len(string_split(text, ','))::int as fields, count(*) as lines "
    "from documents group by 1",
    "parity_label": "select l_partkey as value, case when l_partkey % 2 = 0 then 'Even' "
    "else 'Odd' end as parity from lineitem",
    "binarize_label": f"with {LABELLED} select service, label, new_label from labelled",
    "cast_columns": f"with {RECORDS} select duration, src_bytes, dst_bytes, label from records",
    "drop_columns": f"with {COMMENTS} select * from comments",
    "drop_null_rows": f"""with {COMMENTS} select doc_id, "CONTENT", "CLASS"::int as "CLASS"
      from comments where "CLASS" is not null""",
    "filter_nonempty": """select * from (select doc_id, unnest(string_split(text, ' ')) as piece
      from documents) where piece <> ''""",
    "filter_class": f"""with {COMMENTS} select * from comments where "CLASS" = 1""",
    "tokenize_ws": f"""select * from (select doc_id, unnest(regexp_split_to_array(text,
      '{BLANK}+')) as word from documents) where word <> ''""",
    "tokenize_terms": f"""with {_terms('"CONTENT"', False)} select doc_id, term from terms""",
    "tokenize_terms_without_stop_words": f"""with {_terms('"CONTENT"', True)}
      select doc_id, term from terms""",
    "token_length": f"""select doc_id, len(list_filter(regexp_split_to_array(text, '{BLANK}+'),
      lambda word: word <> ''))::int as comment_length from documents""",
    "clean_text": f"""with {COMMENTS} select doc_id, {CLEANED} as "CONTENT" from comments""",
    "line_count": "select 'line' as key, count(*) as count from documents having count(*) > 0",
    "count_by_protocol": _count_by("protocol_type"),
    "count_by_service": _count_by("service"),
    "count_by_label": _count_by("label"),
    "count_by_flag": _count_by("flag"),
    "count_by_class": f"""with {COMMENTS} select "CLASS", count(*) as count from comments
      where "CLASS" is not null group by 1""",
    "parity_count": "select case when l_partkey % 2 = 0 then 'Even' else 'Odd' end as parity, "
    "count(*) as count from lineitem group by 1",
    "sum_by": "select c_mktsegment as department, round(sum(c_acctbal::float::double), 4) "
    "as salary_sum from customer group by 1",
    "avg_by_item": f"with {RATINGS} select movieId, round(avg(rating), 6) as avg_rating "
    "from ratings group by 1",
    "selected_word_count": f"""with words as (select unnest(regexp_split_to_array(text,
      '{BLANK}+')) as word from documents) select word, count(*) as count from words
      where word in ('the', 'The', 'and', 'de', 'est', 'nowhere-in-the-text') group by 1""",
    "word_count": f"with {WORDS} select word, count from counts",
    "describe_table": f"with {RATINGS} "
    + " union all ".join(_describe(name) for name in ("userId", "movieId", "rating")),
    "describe_percentiles": " union all ".join(
        _percentiles(name) for name in NUMERIC
    ),
    "profile_columns": f"with {COMMENTS} "
    + " union all ".join(
        [
            _profile("doc_id", "bigint", "count(doc_id)"),
            _profile("CONTENT", "string", 'count("CONTENT")'),
            _profile("CLASS", "double", 'count("CLASS")'),
            _profile("DATE", "string", "0::bigint"),
            _profile("Column6", "string", "0::bigint"),
        ]
    ),
    "drop_duplicate_rows": f"""with {COMMENTS} select distinct {CLEANED} as "CONTENT",
      "CLASS"::int as "CLASS" from comments where "CLASS" is not null""",
    "histogram": f"""with sized as (select len(list_filter(regexp_split_to_array(text, '{BLANK}+'),
        lambda word: word <> ''))::double as x from documents),
      span as (select case when min(x) = max(x) then min(x) - 0.5 else min(x) end as low,
        case when min(x) = max(x) then max(x) + 0.5 else max(x) end as high from sized),
      bins as (select range as bin, low + range * ((high - low) / 30) as lo,
        low + (range + 1) * ((high - low) / 30) as hi from range(30), span)
      select bin, round(lo, 6) as left, round(hi, 6) as right, (select count(*) from sized
        where x >= lo and (x < hi or bin = 29)) as count from bins""",
    "log_density": f"""with {RECORDS} select label,
      case when src_bytes > 0 then floor(log10(src_bytes) * 4)::bigint end as bucket_x,
      case when dst_bytes > 0 then floor(log10(dst_bytes) * 4)::bigint end as bucket_y,
      count(*) as count from records group by 1, 2, 3""",
    "label_palette_keys": f"with {RECORDS} select distinct label, label = 'normal.' as is_normal "
    "from records",
    "top_words": f"with {WORDS} select word, count from counts order by count desc, word limit 15",
    "top_words_long": f"with {WORDS} select word, count from counts order by count desc, word limit 12000",
    "top_terms_by_class_long": f"""with {_terms('"CONTENT"', True)} select * from (select "CLASS", term,
      count(*) as count, row_number() over (partition by "CLASS" order by count(*) desc, term)::int
      as rank from terms where "CLASS" is not null group by "CLASS", term) where rank <= 12000""",
    "bottom_words": f"with {WORDS} select word, count from counts order by count, word limit 15",
    "top_rated_items": f"""with {RATINGS} select movieId, round(avg(rating), 6) as avg_rating
      from ratings group by 1 order by avg(rating) desc, movieId limit 12""",
    "top_rated_users": f"""with {RATINGS} select userId, round(avg(rating), 6) as avg_rating
      from ratings group by 1 order by avg(rating) desc, userId limit 12""",
    "top_terms_by_class": f"""with {_terms('"CONTENT"', True)} select * from (select "CLASS", term,
      count(*) as count, row_number() over (partition by "CLASS" order by count(*) desc, term)::int
      as rank from terms where "CLASS" is not null group by "CLASS", term) where rank <= 10""",
    "term_weights": f"""with {_terms('"CONTENT"', True)}, best as (select term, count(*) as count
      from terms where "CLASS" = 1 group by 1 order by 2 desc, 1 limit 200)
      select term, count, round(count / (select max(count) from best), 6) as weight from best""",
    "tfidf_long_small": f"""with {_tfidf('"CONTENT"', 100, True)} select doc_id, term,
      round(weight, 6) as weight from weights""",
    "tfidf_long": f"with {_tfidf(CLEANED, 5000, False)} select doc_id, term, "
    "round(weight, 6) as weight from weights",
    "mean_tfidf_by_class": f"""with {_tfidf('"CONTENT"', 100, True)} select term,
      round(sum(case when "CLASS" = 1 then weight else 0 end)
        / (select count(*) from comments where "CLASS" = 1), 6) as score
      from weights group by term
      order by sum(case when "CLASS" = 1 then weight else 0 end) desc, term desc limit 10""",
    "tfidf_vectors": f"""with {_tfidf(CLEANED, 5000, False)} select doc_id,
      count(term)::int as terms, round(coalesce(sum(weight), 0), 6) as total
      from comments left join weights using (doc_id) group by 1""",
    "index_categories": f"with {LABELLED} "
    + " union all ".join(
        _index(name) for name in ("protocol_type", "service", "flag", "new_label")
    ),
    "index_many_categories": """with rows as (select case when l_orderkey % 3 = 0 then 'hot'
        else l_partkey::varchar end as part, l_suppkey from lineitem),
      a as (select part, (row_number() over (order by count(*) desc, part) - 1)::double as part_indexed from rows group by 1),
      b as (select l_suppkey, (row_number() over (order by count(*) desc, l_suppkey::varchar) - 1)::double
        as l_suppkey_indexed from rows group by 1)
      select part, part_indexed, l_suppkey, l_suppkey_indexed, count(*) as count
      from rows join a using (part) join b using (l_suppkey) group by all""",
    "assemble_features": f"with {RECORDS} select duration as f0, src_bytes as f1, dst_bytes as f2 "
    "from records",
    "fit_features": f"""with {LABELLED} select new_label_place as label_indexed,
      count(*) as count, round(sum(duration), 2) as sum_f0,
      round(sum(protocol_type_place), 2) as sum_f1, round(sum(service_place), 2) as sum_f2,
      round(sum(src_bytes), 2) as sum_f3, round(sum(dst_bytes), 2) as sum_f4,
      round(sum(flag_place), 2) as sum_f5 from labelled join {_place("protocol_type")}
      join {_place("service")} join {_place("flag")} join {_place("new_label")} group by 1""",
    "split_by_hash": f"""select {KEY}, case when
      ('0x' || substr(md5({KEY_TEXT}), 1, 8))::bigint / 4294967296.0 < 0.8
      then 'train' else 'test' end as part from lineitem""",
    "split_by_hash_with_null_keys": f"""with rows as (select {KEY},
      case when l_linenumber > 1 then l_orderkey end as key from lineitem)
      select *, case when coalesce(('0x' || substr(md5(key::varchar), 1, 8))::bigint / 4294967296.0, 0)
        < 0.8 then 'train' else 'test' end as part from rows""",
    "bad_points": f"select {KEY} from lineitem where l_linenumber <= 3",
    "split_exact": f"""select {KEY}, case when row_number() over (order by md5({KEY_TEXT}),
      {KEY_TEXT}) <= ceil(0.2 * (select count(*) from lineitem)) then 'test' else 'train' end as part
      from lineitem""",
    "split_exact_hot_key": f"""with rows as (select {KEY},
        case when l_orderkey % 3 = 0 then 'hot' else l_orderkey::varchar end as key from lineitem)
      select *, case when row_number() over (order by md5(key), key, md5(to_json({{'l_orderkey': l_orderkey,
          'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey, 'key': key}})::varchar))
        <= ceil(0.269::double * (select count(*) from lineitem)) then 'test' else 'train' end as part from rows""",
    "split_exact_equal_rows": """with rows as (select l_returnflag,
        row_number() over (order by md5(l_returnflag), l_returnflag) <= ceil(0.5 * (select count(*) from lineitem)) as low
        from lineitem)
      select l_returnflag, case when low then 'test' else 'train' end as part, count(*) as count from rows group by all""",
    "sample_seeds": f"""with {POINTS} select {KEY}, round(px, 6) as px, round(py, 6) as py
      from points order by md5({KEY_TEXT} || '7'), {KEY_TEXT} limit 8""",
    "assign_nearest_planar": f"{_assigned()} select {KEY}, cid::int as cid from assigned",
    "assign_nearest_wide": f"{WIDE} select vec_id, cid from assigned",
    "assign_nearest_many": """with cells as (select vec_id, unnest(embedding)::double as x,
        generate_subscripts(embedding, 1) as i from embeddings),
      distances as (select a.vec_id, b.vec_id as cid, sum((a.x - b.x) * (a.x - b.x)) as d
        from cells a join cells b using (i) where b.vec_id % 4 = 0 group by all)
      select vec_id, arg_min(cid, (d, cid))::int as cid from distances group by vec_id""",
    "recompute_centroids_planar": f"{_kmeans(1)} select cid::int as cid, size, "
    "round(cx, 6) as cx, round(cy, 6) as cy from c1",
    "recompute_centroids_wide": f"""{WIDE} select cid, (i - 1)::int as place,
      round(avg(x), 6) as value from cells join assigned using (vec_id) group by cid, i""",
    "kmeans_three_steps": f"{_kmeans(3)} select cid::int as cid, round(cx, 6) as cx, "
    "round(cy, 6) as cy from c3",
    "kmeans_fifteen_steps": f"{_kmeans(15)} select cid::int as cid, round(cx, 6) as cx, "
    "round(cy, 6) as cy from c15",
    "kmeans_history_steps": f"{_kmeans(15)} "
    + " union all ".join(
        f"""select {step - 1}::int as iteration, n.cid::int as cid, n.size,
        round(sqrt((n.cx - o.cx) ** 2 + (n.cy - o.cy) ** 2), 6) as shift,
        round(n.cx, 6) as cx, round(n.cy, 6) as cy from c{step} n join c{step - 1} o using (cid)"""
        for step in range(1, 16)
    ),
    "cluster_sizes_planar": f"{_assigned()} select cid::int as cid, count(*) as size "
    "from assigned group by 1",
    "mean_ratings": f"with {RATINGS} select userId, movieId, round(avg(rating), 6) as rating "
    "from ratings group by 1, 2",
    "fit_als": f"with {TRAIN_TEST} select distinct movieId, 10::int as rank from train",
    "predicted_pairs": SCORED,
    "split_random_parts": "select l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) as count "
    "from lineitem group by all",
    "compare_splits_planted": f"""with {RATINGS} select s.train_share, count(*) > 0 as learned
      from ratings, (values (0.7::double), (0.8::double)) as s(train_share) group by 1""",
    "fit_als_planted": f"with {TRAIN_TEST} select distinct movieId, movieId + 20 as number from train",
    "predict_ratings_planted": f"""with {TRAIN_TEST} select userId, movieId,
      (userId % 3 + 1) * (movieId + 20) as prediction from test
      where userId in (select userId from train) and movieId in (select movieId from train)""",
    "recommend_for_users_planted": f"""with {TRAIN_TEST},
      best as (select movieId, row_number() over (order by movieId desc)::int as rank
        from (select distinct movieId from train))
      select userId, rank, movieId, (userId % 3 + 1) * (movieId + 20) as score
      from (select distinct userId from train), best where rank <= 12""",
    "tune_als_planted": """select r as rank, 10::int as maxIter, reg as regParam,
        case when r = 2 and reg < 1 then 1 when r = 1 and reg = 1 then 4 else 2 end::int as place
      from (values (1::int), (2::int)) a(r), (values (0.01::double), (1.0::double)) b(reg)""",
    "best_params_planted": "select 2::int as rank, 10::int as maxIter, 0.01::double as regParam",
    "predict_connections_planted": f"""with {RECORDS},
      planted as (select *, case when dst_bytes > 25 then 'attack' else 'normal' end as new_label from records)
      select count(*) as rows, count(distinct new_label) = 2 as learned from planted
      where ('0x' || substr(md5({RECORD_TEXT} || '42'), 1, 8))::bigint / 4294967296.0 >= 0.8""",
    **{
        f"{name}_planted": f"""with {COMMENTS}, ready as (select distinct {CLEANED} as "CONTENT",
          contains("CONTENT", ' the ') as "CLASS" from comments)
          select ceil(0.2::double * count(*))::bigint as rows, count(distinct "CLASS") = 2 as learned from ready"""
        for name in ("fit_logistic", "fit_random_forest")
    },
    "rmse": f"with {PAIRS.format(n=3)} select round(sqrt(avg((label - prediction) ** 2)), 6) as rmse "
    "from pairs",
    "mae": f"with {PAIRS.format(n=3)} select round(avg(abs(label - prediction)), 6) as mae from pairs",
    "accuracy": f"with {PAIRS.format(n=3)} select round(avg((label = prediction)::int), 6) "
    "as accuracy from pairs",
    "f1_weighted": f"with {REPORT} select round(sum(f1 * support) / sum(support), 6) as f1 from report",
    "confusion_matrix": f"with {_confusion(3)} select label, prediction, count from pairs_cells",
    "classification_report": f"""with {REPORT} select class::varchar as class,
        round("precision", 6) as "precision", round(recall, 6) as recall, round(f1, 6) as f1, support
        from report
      union all select 'accuracy', null, null, round(sum(hits) / sum(support), 6),
        sum(support)::bigint from report
      union all select 'macro avg', round(avg("precision"), 6), round(avg(recall), 6),
        round(avg(f1), 6), sum(support)::bigint from report
      union all select 'weighted avg', round(sum("precision" * support) / sum(support), 6),
        round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
        sum(support)::bigint from report""",
    "compare_models": f"with {_confusion(3, 'thirds')}, {_confusion(5, 'fifths')} "
    f"{_model_rows('thirds', 'thirds')} union all {_model_rows('fifths', 'fifths')}",
}

# the same results by other plans
ORACLES |= {
    "tfidf_long_from_table": ORACLES["tfidf_long"],
    "tfidf_vectors_from_table": ORACLES["tfidf_vectors"],
    "mean_tfidf_by_class_from_table": ORACLES["mean_tfidf_by_class"],
    "tfidf_long_of_all_terms": f"""with {_tfidf('"CONTENT"', 2_000_000_000, False)} select doc_id, term,
      round(weight, 6) as weight from weights""",
}
