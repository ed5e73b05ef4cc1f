"""SQL over the same Parquet tables with the same results as the registered queries (DuckDB dialect).

Written independently of the operators: tokens are split and trimmed word by word, co-occurrence is a
self join, rank mass of dangling nodes flows along written-out edges, and the ROC measure ranks all
instances in one window.
"""

from __future__ import annotations

import math

from brindle.functions.numeric import RATE_BOUNDS
from brindle.operators.arrivals import GROWTH, MIN_ARRIVALS
from brindle.operators.pagerank import ALPHA
from brindle.operators.scoring import INTERVAL, RESAMPLES
from brindle.operators.training import BATCHES, DELTA, SHARDS
from brindle.plans.registry import (
    AND_QUERY,
    BOXES,
    DAY,
    EPOCHS,
    MISSING_SIZE,
    MODELS,
    NATIONS,
    NESTED_QUERY,
    OR_QUERY,
    PART_OFFSET,
    SEED,
    SOURCES,
)

SQL: dict[str, str] = {}

# Shipments -------------------------------------------------------------------------------------

SHIPPED = f"CAST(l_shipdate AS DATE) = DATE '{DAY}'"
DISCOUNTED = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
CHARGE = f"{DISCOUNTED} * (1 + CAST(l_tax AS DECIMAL(4,2)))"

SQL["q1_shipped_count"] = f"SELECT count(*) AS count FROM lineitem WHERE {SHIPPED}"

SQL["q2_clerk_orders"] = SQL["sql_clerk_orders"] = f"""
SELECT o_orderpriority, o_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE {SHIPPED} ORDER BY o_orderkey, o_orderpriority LIMIT 20"""

SQL["q3_part_supplier"] = f"""
SELECT l_orderkey, p_name, s_name FROM lineitem
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE {SHIPPED} ORDER BY l_orderkey, p_name, s_name LIMIT 20"""

SQL["q4_nation_shipments"] = SQL["sql_nation_shipments"] = f"""
SELECT n_nationkey, n_name, count(*) AS count FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
WHERE {SHIPPED} GROUP BY n_nationkey, n_name"""

SQL["q5_monthly_two_nations"] = f"""
SELECT n_nationkey, upper(trim(n_name)) AS n_name, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
WHERE upper(trim(n_name)) IN ({", ".join(f"'{n}'" for n in NATIONS)}) GROUP BY ALL"""

SQL["q6_pricing_summary"] = SQL["pricing_from_pipe_text"] = f"""
SELECT l_returnflag, l_linestatus,
    sum(CAST(l_quantity AS DECIMAL(12,2)))::DOUBLE AS sum_qty,
    sum(CAST(l_extendedprice AS DECIMAL(12,2)))::DOUBLE AS sum_base_price,
    round(sum({DISCOUNTED})::DOUBLE, 4) AS sum_disc_price,
    round(sum({CHARGE})::DOUBLE, 6) AS sum_charge,
    round(sum(CAST(l_quantity AS DECIMAL(12,2)))::DOUBLE / count(*), 6) AS avg_qty,
    round(sum(CAST(l_extendedprice AS DECIMAL(12,2)))::DOUBLE / count(*), 6) AS avg_price,
    round(sum(CAST(l_discount AS DECIMAL(4,2)))::DOUBLE / count(*), 6) AS avg_disc,
    count(*) AS count_order
FROM lineitem WHERE {SHIPPED} GROUP BY ALL"""

SQL["sql_pricing_summary"] = f"""
SELECT l_returnflag, l_linestatus, sum_qty, sum_base_price, sum_disc_price, sum_charge, avg_qty, avg_price, avg_disc, count_order
FROM ({SQL["q6_pricing_summary"]})"""

SQL["q7_top_unshipped"] = f"""
SELECT c_name, l_orderkey, round(revenue::DOUBLE, 4) AS revenue, o_orderdate, o_orderpriority FROM (
    SELECT c_name, l_orderkey, sum({DISCOUNTED}) AS revenue,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE CAST(o_orderdate AS DATE) < DATE '{DAY}' AND CAST(l_shipdate AS DATE) > DATE '{DAY}'
    GROUP BY ALL ORDER BY revenue DESC, c_name, l_orderkey, o_orderdate, o_orderpriority LIMIT 5)"""

# Text ------------------------------------------------------------------------------------------


def _tokens(text: str) -> str:
    return rf"""list_filter(list_transform(string_split_regex({text}, '[ \t\n\r\f]+'),
        lambda w: regexp_replace(lower(w), '^[^a-z]+|[^a-z]+$', '', 'g')), lambda w: w <> '')"""


LINES = rf"""
split AS (SELECT doc_id, string_split_regex(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r') AS parts
          FROM documents WHERE text <> ''),
lines AS (SELECT doc_id, unnest(range(len(parts)))::INT AS line_no, unnest(parts) AS line FROM split),
tok AS (SELECT doc_id, line_no, {_tokens("line")} AS tokens FROM lines)"""

WORDS = f"""{LINES},
words AS (SELECT doc_id, line_no, unnest(list_distinct(tokens[1:40])) AS w FROM tok),
counts AS (SELECT w, count(*) AS c FROM words GROUP BY w)"""

SQL["tokens"] = f"""WITH {LINES}
SELECT doc_id, line_no, len(tokens)::INT AS n, array_to_string(tokens, ' ') AS tokens FROM tok"""

SQL["word_line_counts"] = f"""WITH {WORDS}
SELECT w AS word, c AS n FROM counts UNION ALL SELECT '*', count(*) FROM lines"""

BIGRAMS = f"""{LINES},
bigrams AS (SELECT unnest(tokens[:-2]) AS w1, unnest(tokens[2:]) AS w2 FROM tok WHERE len(tokens) > 1),
cells AS (SELECT w1, w2, count(*) AS n FROM bigrams GROUP BY ALL),
freq AS (SELECT w1, w2, n / sum(n) OVER (PARTITION BY w1) AS value FROM cells)"""

SQL["bigram_freq_pairs"] = f"""WITH {BIGRAMS}
SELECT w1, w2, round(value, 9) AS value FROM freq
UNION ALL SELECT w1, '*', count(*)::DOUBLE FROM bigrams GROUP BY w1"""

SQL["bigram_text_sink"] = f"""WITH {BIGRAMS}
SELECT '((' || w1 || ', ' || w2 || '), ' || n || ')' AS line FROM cells"""

SQL["bigram_freq_stripes"] = f"""WITH {BIGRAMS}
SELECT w1, 0 AS block, string_agg(w2 || ':' || round(value * 1e6)::BIGINT, ' ' ORDER BY w2) AS stripe FROM freq GROUP BY w1"""

PMI = f"""{WORDS},
often AS MATERIALIZED (SELECT w, c, row_number() OVER () AS k FROM counts WHERE c >= 10),
keyed AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY doc_id, line_no) AS line, k FROM words JOIN often USING (w)),
half AS MATERIALIZED (SELECT a.k AS k1, b.k AS k2, count(*) AS n FROM keyed a JOIN keyed b ON a.line = b.line AND a.k < b.k
          GROUP BY ALL HAVING count(*) >= 10),
pairs AS (SELECT x.w AS w1, y.w AS w2, n FROM (SELECT * FROM half UNION ALL SELECT k2, k1, n FROM half)
          JOIN often x ON x.k = k1 JOIN often y ON y.k = k2),
pmi AS (SELECT w1, w2, log10(n::DOUBLE * (SELECT count(*) FROM lines) / (x.c::DOUBLE * y.c::DOUBLE)) AS pmi, n
        FROM pairs JOIN counts x ON x.w = w1 JOIN counts y ON y.w = w2)"""

SQL["pmi_pairs"] = SQL["pmi_pairs_pruned"] = f"WITH {PMI} SELECT w1, w2, round(pmi, 6) AS pmi, n FROM pmi"

SQL["pmi_stripes"] = f"""WITH {PMI}
SELECT w1, 0 AS block, string_agg(w2 || ':' || round(pmi * 1e6)::BIGINT || '/' || n, ' ' ORDER BY w2) AS stripe
FROM pmi GROUP BY w1"""

# Index -----------------------------------------------------------------------------------------

POSTINGS = f"""
terms AS (SELECT doc_id, unnest({_tokens("text")}) AS term FROM documents),
tf AS (SELECT term, doc_id, count(*) AS tf FROM terms GROUP BY ALL),
gaps AS (SELECT term, doc_id, tf, doc_id - lag(doc_id, 1, 0) OVER (PARTITION BY term ORDER BY doc_id) AS gap FROM tf)"""

SQL["index_postings"] = SQL["index_stored"] = SQL["index_gap_decode"] = f"""WITH {POSTINGS}
SELECT term, doc_id // 65536 AS block, count(*) AS block_df,
    string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id) AS postings FROM tf GROUP BY ALL"""

SQL["index_gaps"] = f"""WITH {POSTINGS}
SELECT term, doc_id // 65536 AS block, count(*) AS block_df,
    string_agg(gap || ':' || tf, ' ' ORDER BY doc_id) AS gaps FROM gaps GROUP BY ALL"""


def _coded(value: str) -> str:
    return f"""CASE WHEN {value} <= 127 THEN 1 WHEN {value} <= 255 THEN 2 WHEN {value} <= 65535 THEN 3
        WHEN {value} <= 16777215 THEN 4 ELSE 5 END"""


SQL["index_size_report"] = f"""WITH {POSTINGS},
per_term AS (SELECT term, count(*) AS df, sum({_coded("gap")} + {_coded("tf")}) AS body FROM gaps GROUP BY term)
SELECT term, df, (body + {_coded("df")})::BIGINT AS coded, 4 * (2 * df + 1) AS plain FROM per_term"""

SQL["term_df"] = f"WITH {POSTINGS} SELECT term, count(*) AS df FROM tf GROUP BY term"


def _postfix_sql(postfix: str) -> str:
    stack: list[str] = []
    for token in postfix.split():
        if token in ("AND", "OR"):
            right, left = stack.pop(), stack.pop()
            stack.append(f"({left} {'INTERSECT' if token == 'AND' else 'UNION'} {right})")
        else:
            stack.append(f"(SELECT doc_id FROM tf WHERE term = '{token}')")
    return stack.pop()


for _name, _postfix in (("and", AND_QUERY), ("or", OR_QUERY), ("nested", NESTED_QUERY)):
    SQL[f"boolean_{_name}"] = f"WITH {POSTINGS} SELECT doc_id FROM {_postfix_sql(_postfix)}"

SQL["boolean_batch"] = f"""WITH {POSTINGS},
wanted AS (SELECT item_id AS query_id, list_sort(list_distinct({_tokens("text")})) AS words FROM benchmark),
long AS (SELECT query_id, words, unnest(words) AS term FROM wanted WHERE len(words) > 2),
matched AS (SELECT query_id, doc_id, words, list(term) AS found FROM long JOIN tf USING (term) GROUP BY ALL)
SELECT query_id, doc_id FROM matched
WHERE (list_contains(found, words[1]) OR list_contains(found, words[-1])) AND list_has_all(found, words[2:-2])"""

SQL["retrieval_snippets"] = f"""WITH {POSTINGS}
SELECT doc_id, CASE WHEN length(text) > 80 THEN text[1:80] || '...' ELSE text END AS snippet
FROM {_postfix_sql(NESTED_QUERY)} JOIN documents USING (doc_id)"""

# Graph -----------------------------------------------------------------------------------------


def _graph_sql(part_filter: str = "true") -> str:
    sources = ", ".join(f"({s})" for s in SOURCES)
    return f"""
pairs AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem),
edges AS (SELECT s AS src, {PART_OFFSET} + p AS dst FROM pairs
          UNION ALL SELECT {PART_OFFSET} + p, s FROM pairs JOIN part ON p = p_partkey WHERE p_size % 2 = 0),
nodes AS (SELECT s_suppkey AS id FROM supplier
          UNION ALL SELECT {PART_OFFSET} + p_partkey FROM part WHERE {part_filter}),
sources(id) AS (VALUES {sources}),
repair AS (SELECT n.id AS src, s.id AS dst FROM nodes n, sources s WHERE n.id NOT IN (SELECT src FROM edges)),
links AS (SELECT * FROM edges UNION ALL SELECT * FROM repair),
deg AS (SELECT src, count(*) AS d FROM links GROUP BY src),
r0 AS (SELECT id, CASE WHEN id IN (SELECT id FROM sources) THEN 1.0::DOUBLE / {len(SOURCES)} ELSE 0.0::DOUBLE END AS rank
       FROM nodes)"""


def _ranks_sql(iterations: int, part_filter: str = "true") -> str:
    steps = [_graph_sql(part_filter)]
    for i in range(1, iterations + 1):
        steps.append(f"""
r{i} AS MATERIALIZED (SELECT n.id,
    CASE WHEN n.id IN (SELECT id FROM sources) THEN {ALPHA}::DOUBLE / {len(SOURCES)} ELSE 0.0::DOUBLE END
    + (1 - {ALPHA}::DOUBLE) * coalesce(mass, 0) AS rank
  FROM nodes n LEFT JOIN (SELECT dst, sum(rank / d) AS mass FROM links JOIN r{i - 1} r ON r.id = src
                          JOIN deg USING (src) GROUP BY dst) ON dst = n.id)""")
    return ",".join(steps)


SQL["graph_stats"] = f"""WITH {_graph_sql()}
SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges,
    (SELECT count(*) FROM nodes WHERE id IN (SELECT src FROM edges)) AS active_nodes"""

SQL["graph_from_adjacency_text"] = SQL["graph_stats"]

SQL["graph_dangling"] = f"WITH {_graph_sql()} SELECT src AS id, count(*) AS added FROM repair GROUP BY src"

SQL["pagerank_iter1"] = f"WITH {_ranks_sql(1)} SELECT id, round(rank, 9) AS rank FROM r1"

SQL["pagerank_iter5"] = SQL["pagerank_resumed"] = f"WITH {_ranks_sql(5)} SELECT id, round(rank, 9) AS rank FROM r5"

SQL["pagerank_topk"] = f"""WITH {_ranks_sql(20)}
SELECT printf('%.5f', rank) AS rank, id FROM r20 ORDER BY r20.rank DESC, id LIMIT 10"""


def _stats_sql(part_filter: str = "true") -> str:
    return f"""WITH {_ranks_sql(2, part_filter)},
sent AS (SELECT count(*) AS n FROM links WHERE src IN (SELECT id FROM nodes)),
lost AS (SELECT count(DISTINCT dst) AS n FROM links
         WHERE src IN (SELECT id FROM nodes) AND dst NOT IN (SELECT id FROM nodes))
SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT n FROM sent) AS edges, (SELECT n FROM sent) AS messages,
    (SELECT n FROM lost) AS missing, round((SELECT sum(rank) FROM r2), 9) AS mass"""


SQL["pagerank_mass"] = _stats_sql()
SQL["pagerank_missing"] = _stats_sql(f"p_size <> {MISSING_SIZE}")

# Classification --------------------------------------------------------------------------------

FEATURES = f"""
inst AS (SELECT doc_id, CASE WHEN quality = 0 THEN 'spam' ELSE 'ham' END AS label, {_tokens("text")} AS tokens
         FROM documents JOIN labels USING (doc_id)),
feats AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 6))::INT AS f
          FROM (SELECT doc_id, unnest(tokens) AS w FROM inst)),
w AS (SELECT f, {", ".join(f"(f * {i + 1}::BIGINT % 17 - 8) / 64.0::DOUBLE AS {m}" for i, m in enumerate(MODELS))}
      FROM (SELECT DISTINCT f FROM feats)),
s AS (SELECT inst.doc_id::VARCHAR AS doc_id, label, {", ".join(f"coalesce(sum({m}), 0.0) AS {m}" for m in MODELS)}
      FROM inst LEFT JOIN feats USING (doc_id) LEFT JOIN w USING (f) GROUP BY inst.doc_id, label),
scored AS (SELECT doc_id, label, {MODELS[0]} AS score, CASE WHEN {MODELS[0]} > 0 THEN 'spam' ELSE 'ham' END AS predicted
           FROM s)"""


def _ensemble_sql(score: str) -> str:
    return f"""WITH {FEATURES}
SELECT doc_id, label, round(score, 9) AS score, CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS predicted
FROM (SELECT doc_id, label, {score} AS score FROM s)"""


SQL["spam_scores"] = SQL["spam_scores_from_text"] = f"WITH {FEATURES} SELECT * FROM scored"
SQL["spam_average"] = _ensemble_sql(f"({' + '.join(MODELS)}) / {len(MODELS)}")
SQL["ensemble_from_text"] = SQL["spam_average"]
SQL["spam_vote"] = _ensemble_sql(" + ".join(f"CASE WHEN {m} > 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END" for m in MODELS))


def _batch_sql(epochs: int) -> str:
    parts = [FEATURES, """
y AS (SELECT doc_id, CASE WHEN label = 'spam' THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM inst),
w0 AS (SELECT DISTINCT f, 0.0::DOUBLE AS weight FROM feats)"""]
    for i in range(1, epochs + 1):
        parts.append(f"""
p{i} AS (SELECT doc_id, 1 / (1 + exp(-sum(weight))) AS p FROM feats JOIN w{i - 1} USING (f) GROUP BY doc_id),
w{i} AS (SELECT f, any_value(weight) + sum((y - p) * {DELTA}) AS weight
         FROM feats JOIN y USING (doc_id) JOIN p{i} USING (doc_id) JOIN w{i - 1} USING (f) GROUP BY f)""")
    return f"""WITH {",".join(parts)}
SELECT 'model' AS model_id, f AS feature, round(weight, 9) AS weight FROM w{epochs}"""


SQL["spam_train_batch"] = _batch_sql(EPOCHS)


def _minibatch_sql(seed: int, model: str = "'all'") -> str:
    """One pass in BATCHES parts, each step materialized: the part of an instance follows from its md5."""
    parts = [FEATURES, f"""
x AS MATERIALIZED (SELECT {model} AS m, doc_id, f, CASE WHEN label = 'spam' THEN 1.0 ELSE 0.0 END::DOUBLE AS y,
    ('0x' || substr(md5('{seed}:' || doc_id), 1, 8))::BIGINT % {BATCHES} AS part FROM feats JOIN inst USING (doc_id)),
w0 AS (SELECT DISTINCT m, f, 0.0::DOUBLE AS weight FROM x)"""]
    for i in range(BATCHES):
        parts.append(f"""
p{i} AS MATERIALIZED (SELECT m, doc_id, 1 / (1 + exp(-sum(weight))) AS p
    FROM x JOIN w{i} USING (m, f) WHERE part = {i} GROUP BY m, doc_id),
d{i} AS MATERIALIZED (SELECT m, f, sum((y - p) * {DELTA}) AS d FROM x JOIN p{i} USING (m, doc_id) GROUP BY m, f),
w{i + 1} AS MATERIALIZED (SELECT w{i}.m, w{i}.f, weight + coalesce(d, 0) AS weight FROM w{i} LEFT JOIN d{i} USING (m, f))""")
    return f"""WITH {",".join(parts)}
SELECT m AS model_id, f AS feature, round(weight, 9) AS weight FROM w{BATCHES}"""


SQL["spam_train_sgd"] = _minibatch_sql(0)
SQL["spam_train_shuffled"] = _minibatch_sql(SEED)
SQL["spam_train_groups"] = _minibatch_sql(0, f"'m' || (doc_id % {len(MODELS)})")
#: Instances of the largest shard that the SQL unrolls; enough for the test tables up to sf0.1.
LONGEST = 40


def _mixed_sql() -> str:
    """Every shard in sequence, its instances numbered by their hash; then the average by size."""
    parts = [FEATURES, f"""
o AS MATERIALIZED (SELECT doc_id, label, ('0x' || substr(md5('0:' || doc_id), 1, 8))::BIGINT AS position FROM inst),
r AS MATERIALIZED (SELECT doc_id, position % {SHARDS} AS m, CASE WHEN label = 'spam' THEN 1.0 ELSE 0.0 END::DOUBLE AS y,
    row_number() OVER (PARTITION BY position % {SHARDS} ORDER BY position, doc_id) - 1 AS part FROM o),
x AS MATERIALIZED (SELECT m, doc_id, f, y, part FROM feats JOIN r USING (doc_id)),
w0 AS (SELECT DISTINCT m, f, 0.0::DOUBLE AS weight FROM x)"""]
    for i in range(LONGEST):
        parts.append(f"""
p{i} AS MATERIALIZED (SELECT m, doc_id, 1 / (1 + exp(-sum(weight))) AS p
    FROM x JOIN w{i} USING (m, f) WHERE part = {i} GROUP BY m, doc_id),
d{i} AS MATERIALIZED (SELECT m, f, sum((y - p) * {DELTA}) AS d FROM x JOIN p{i} USING (m, doc_id) GROUP BY m, f),
w{i + 1} AS MATERIALIZED (SELECT w{i}.m, w{i}.f, weight + coalesce(d, 0) AS weight FROM w{i} LEFT JOIN d{i} USING (m, f))""")
    return f"""WITH {",".join(parts)}
SELECT 'all' AS model_id, f AS feature, round(sum(weight * n) / (SELECT count(*) FROM r), 9) AS weight
FROM w{LONGEST} JOIN (SELECT m, count(*) AS n FROM r GROUP BY m) USING (m) GROUP BY f"""


SQL["spam_train_mixed"] = _mixed_sql()
SQL["labels_in_random_order"] = f"""
SELECT doc_id, quality, ('0x' || substr(md5('{SEED}:' || doc_id), 1, 8))::BIGINT AS position FROM labels"""

SQL["confusion"] = f"""WITH {FEATURES}
SELECT count(*) FILTER (label = 'ham') AS hams, count(*) FILTER (label = 'spam') AS spams,
    count(*) FILTER (label = 'ham' AND predicted = 'spam') AS fp,
    count(*) FILTER (label = 'spam' AND predicted = 'ham') AS fn FROM scored"""

INVERSIONS = """
SELECT count(*) FILTER (label = 'ham') AS hams, count(*) FILTER (label = 'spam') AS spams,
    coalesce(sum(below + ties / 2.0) FILTER (label = 'ham'), 0)::DOUBLE AS inversions
FROM (SELECT label,
        count(*) FILTER (label = 'spam') OVER (ORDER BY score RANGE UNBOUNDED PRECEDING)
            - count(*) FILTER (label = 'spam') OVER (PARTITION BY score) AS below,
        count(*) FILTER (label = 'spam') OVER (PARTITION BY score) AS ties FROM scored)"""

SQL["roc_area"] = f"""WITH {FEATURES}
SELECT hams, spams, inversions, round(100 * greatest(inversions, 0.5) / (hams::DOUBLE * spams), 6) AS roca_pct
FROM ({INVERSIONS})"""


def _logit_sql(x: str) -> str:
    return f"CASE WHEN {x} > 0 AND {x} < 1 THEN ln({x} / (1 - ({x}))) END"


SQL["lam"] = f"""WITH {FEATURES}
SELECT fp, fn, round(100 / (1 + exp(-({_logit_sql("fn / spams")} + {_logit_sql("fp / hams")}) / 2)), 6) AS lam_pct
FROM ({SQL["confusion"]})"""


def _bucket_sql(rate: str) -> str:
    return f"CASE {' '.join(f'WHEN {rate} <= {b}::DOUBLE THEN {i}' for i, b in enumerate(RATE_BOUNDS[:-1]))} ELSE 12 END"


SQL["rate_curve"] = f"""WITH {FEATURES},
per_score AS (SELECT score, count(*) FILTER (label = 'ham') AS h, count(*) FILTER (label = 'spam') AS sp
              FROM scored GROUP BY score),
cuts AS (SELECT greatest(sum(h) OVER () - sum(h) OVER (ORDER BY score), 0.5)::DOUBLE / sum(h) OVER () AS fp,
                greatest(sum(sp) OVER (ORDER BY score), 0.5)::DOUBLE / sum(sp) OVER () AS fn FROM per_score),
a AS (SELECT {_bucket_sql("fn")} AS bucket, min(fp) AS fp_at_fn FROM cuts GROUP BY ALL),
b AS (SELECT {_bucket_sql("fp")} AS bucket, min(fn) AS fn_at_fp FROM cuts GROUP BY ALL)
SELECT bucket::INT AS bucket, list_extract({RATE_BOUNDS}::DOUBLE[], bucket + 1) AS bound,
    round(fp_at_fn, 6) AS fp_at_fn, round(fn_at_fp, 6) AS fn_at_fp FROM a FULL JOIN b USING (bucket)"""

DRAW = f"('0x' || substr(md5('{SEED}:' || k || ':' || doc_id), 1, 8))::BIGINT"
# The weight counts the values of the Poisson(1) distribution function, in 32 bits, that the draw reaches.
WEIGHT = " + ".join(f"(draw >= floor(4294967296 * ({' + '.join(f'exp(-1) / {math.factorial(i)}' for i in range(k + 1))})))::INT" for k in range(13))

SQL["roc_bootstrap"] = f"""WITH {FEATURES},
drawn AS (SELECT k, label, predicted, score, {DRAW} AS draw FROM scored, range({RESAMPLES}) r(k)),
weighted AS (SELECT k, label, predicted, score, {WEIGHT} AS n FROM drawn),
per_score AS (SELECT k, score, sum(n) FILTER (label = 'ham') AS h, sum(n) FILTER (label = 'spam') AS sp
              FROM weighted WHERE n > 0 GROUP BY k, score),
filled AS (SELECT k, score, coalesce(h, 0) AS h, coalesce(sp, 0) AS sp FROM per_score),
areas AS (SELECT k, greatest(sum(h * (below - sp / 2)), 0.5)::DOUBLE / (sum(h)::DOUBLE * sum(sp)) AS a
          FROM (SELECT *, sum(sp) OVER (PARTITION BY k ORDER BY score) AS below FROM filled) GROUP BY k),
errors AS (SELECT k, coalesce(sum(n) FILTER (label = 'spam' AND predicted = 'ham'), 0) / sum(n) FILTER (label = 'spam') AS fn,
                  coalesce(sum(n) FILTER (label = 'ham' AND predicted = 'spam'), 0) / sum(n) FILTER (label = 'ham') AS fp
           FROM weighted WHERE n > 0 GROUP BY k),
spread AS (SELECT stddev_samp({_logit_sql("a")}) AS sd_x, stddev_samp(({_logit_sql("fn")} + {_logit_sql("fp")}) / 2) AS sd_lam
           FROM areas JOIN errors USING (k)),
point AS (SELECT {_logit_sql("(greatest(inversions, 0.5) / (hams::DOUBLE * spams))")} AS x FROM ({INVERSIONS})),
wrong AS (SELECT ({_logit_sql("fn / spams")} + {_logit_sql("fp / hams")}) / 2 AS l FROM ({SQL["confusion"]}))
SELECT round(100 / (1 + exp(-x)), 6) AS roca_pct,
    round(100 / (1 + exp(-(x - {INTERVAL} * sd_x))), 6) AS roca_low,
    round(100 / (1 + exp(-(x + {INTERVAL} * sd_x))), 6) AS roca_high,
    round(100 / (1 + exp(-l)), 6) AS lam_pct,
    round(100 / (1 + exp(-(l - {INTERVAL} * sd_lam))), 6) AS lam_low,
    round(100 / (1 + exp(-(l + {INTERVAL} * sd_lam))), 6) AS lam_high
FROM point, wrong, spread"""

# Arrivals --------------------------------------------------------------------------------------

REGION = "CASE " + " ".join(
    f"WHEN value > {b.min_x} AND value < {b.max_x} AND user_id > {b.min_y} AND user_id < {b.max_y} THEN '{b.name}'"
    for b in BOXES
) + " END"


def _arrivals_sql(length: int, slide: int) -> str:
    """Windows in hours; every event is in length/slide of them."""
    return f"""
placed AS (SELECT {REGION} AS region, (epoch_us(ts) // ({slide} * 3600000000)) * {slide * 3600} AS latest FROM events),
hits AS (SELECT region, latest - k * {slide * 3600} AS start FROM placed, range({length // slide}) r(k)
         WHERE region IS NOT NULL),
busy AS (SELECT region, start, count(*) AS n FROM hits GROUP BY ALL),
spine AS (SELECT region, unnest(range(min(start), (SELECT max(latest) FROM placed) + 1, {slide * 3600})) AS start
          FROM busy GROUP BY region),
dense AS (SELECT region, start, coalesce(n, 0) AS n FROM spine LEFT JOIN busy USING (region, start)),
shown AS (SELECT region, strftime(make_timestamp(start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
                 strftime(make_timestamp((start + {length * 3600}) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, n AS count,
                 lag(n, 1, 0) OVER (PARTITION BY region ORDER BY start) AS previous,
                 (start + {length * 3600}) * 1000 AS end_ms
          FROM dense)"""


def _counts_sql(length: int, slide: int) -> str:
    return f"WITH {_arrivals_sql(length, slide)} SELECT region, window_start, window_end, count FROM shown"


SQL["region_hourly"] = SQL["region_from_trip_text"] = SQL["stream_region_hourly"] = _counts_sql(1, 1)
SQL["stream_region_batches"] = SQL["region_hourly"]
SQL["region_sliding"] = SQL["stream_region_sliding"] = _counts_sql(6, 2)

SQL["arrivals_history"] = f"""WITH {_arrivals_sql(1, 1)}
SELECT region, window_start, window_end, count, previous FROM shown"""

SQL["trending"] = SQL["stream_trending"] = SQL["stream_trending_partitioned"] = f"""WITH {_arrivals_sql(6, 6)}
SELECT region, window_start, window_end, count, previous,
    format('Number of arrivals to {{}} has doubled from {{}} to {{}} at {{}}!', region, previous, count, end_ms) AS message
FROM shown WHERE count >= {MIN_ARRIVALS} AND count >= {GROWTH} * previous"""
