"""The same results in DuckDB SQL, written independently of the Spark side."""

from __future__ import annotations

TAGS = ("bulk", "open", "returned")

# --- shared tables -----------------------------------------------------------------------------

REVIEWS = """reviews AS (
  SELECT CAST(l_partkey AS VARCHAR) AS recipe_id, CAST(o_custkey AS VARCHAR) AS user_id, l_shipdate AS ts,
    CAST(1 + (CAST(l_quantity AS BIGINT) - 1) % 5 AS DOUBLE) AS rating,
    CAST(l_returnflag = 'R' AS INTEGER) AS pred_returned, l_discount * 10 AS sim_returned,
    CAST(l_linestatus = 'O' AS INTEGER) AS pred_open, l_tax * 10 AS sim_open,
    CAST(l_quantity > 40 AS INTEGER) AS pred_bulk, l_quantity / 50 AS sim_bulk
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ITEMS = """items AS (
  SELECT CAST(p_partkey AS VARCHAR) AS recipe_id, p_name AS name, p_name AS tags_clean,
    lower(p_type || ' ' || replace(p_brand, '#', '_')) AS ingredients_clean,
    CAST(p_size AS BIGINT) AS size, p_retailprice AS price
  FROM part)"""


def level(source: str = "reviews", tags=TAGS, m: str = "quantile_cont(review_count, 0.25)") -> str:
    shares = ", ".join(f"coalesce(avg(CAST(pred_{t} AS DOUBLE)), 0) AS pred_{t}" for t in tags)
    strength = ", ".join(
        f"coalesce(avg(sim_{t}) FILTER (WHERE pred_{t} = 1), 0) AS intensity_{t}" for t in tags
    )
    seen = " + ".join(f"pred_{t}" for t in tags)
    names = ", ".join([f"pred_{t}" for t in tags] + [f"intensity_{t}" for t in tags])
    return f"""level_all AS (
  SELECT recipe_id, coalesce(avg(rating), 0) AS raw_mean_rating, count(rating) AS review_count,
    {shares}, {strength}
  FROM {source} GROUP BY recipe_id),
scalars AS (SELECT (SELECT avg(rating) FROM {source}) AS c, (SELECT {m} FROM level_all) AS m),
level_rated AS (
  SELECT recipe_id, raw_mean_rating, review_count,
    (review_count * raw_mean_rating + m * c) / (review_count + m) AS bayesian_rating, {names}
  FROM level_all, scalars),
level AS (SELECT * FROM level_rated WHERE {seen} > 0)"""


RARE = """rare AS (
  SELECT CAST(l_partkey AS VARCHAR) AS recipe_id,
    CAST(1 + (CAST(l_quantity AS BIGINT) - 1) % 5 AS DOUBLE) AS rating,
    CAST(l_quantity = 50 AND l_discount >= 0.1 AS INTEGER) AS pred_rare, l_discount AS sim_rare
  FROM lineitem)"""

MERGED = """merged AS (
  SELECT i.*, raw_mean_rating, review_count, bayesian_rating, pred_bulk, pred_open, pred_returned,
    intensity_bulk, intensity_open, intensity_returned
  FROM items i JOIN level USING (recipe_id))"""


def clean(column: str, places: int = 6) -> str:
    return f"round({column}, {places}) + 0.0 AS {column}"


LEVEL_COLUMNS = ", ".join(
    ["recipe_id", clean("raw_mean_rating"), "review_count", clean("bayesian_rating")]
    + [clean(f"pred_{t}") for t in TAGS]
    + [clean(f"intensity_{t}") for t in TAGS]
)

LEVEL = f"{REVIEWS}, {level()}"
FULL = f"{LEVEL}, {ITEMS}, {MERGED}"

# Scaled rows.
SCALED = f"""stats AS (
  SELECT avg(size) AS mean_size, stddev_pop(size) AS dev_size, avg(price) AS mean_price,
    stddev_pop(price) AS dev_price,
    {", ".join(f"min(intensity_{t}) AS lo_{t}, max(intensity_{t}) AS hi_{t}" for t in TAGS)}
  FROM merged),
scaled AS (
  SELECT recipe_id, name, tags_clean, ingredients_clean, (size - mean_size) / dev_size AS size,
    (price - mean_price) / dev_price AS price, raw_mean_rating, review_count, bayesian_rating,
    pred_bulk, pred_open, pred_returned,
    {", ".join(f"(intensity_{t} - lo_{t}) / (hi_{t} - lo_{t}) AS intensity_{t}" for t in TAGS)}
  FROM merged, stats)"""


def vocabulary(name: str, source: str, column: str, top_n: int) -> str:
    return f"""{name} AS (
  SELECT token, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, token) AS place
  FROM (SELECT unnest(string_split({column}, ' ')) AS token FROM {source})
  GROUP BY token ORDER BY count(*) DESC, token LIMIT {top_n})"""


VOCABS = f"""{vocabulary("cats", "merged", "tags_clean", 100)},
{vocabulary("ings", "merged", "ingredients_clean", 100)}"""

INDICATORS = """shown AS (
  SELECT recipe_id, string_agg(feature, ' ' ORDER BY feature) AS indicators FROM (
    SELECT DISTINCT recipe_id, 'cat_' || token AS feature
    FROM (SELECT recipe_id, unnest(string_split(tags_clean, ' ')) AS token FROM merged) JOIN cats USING (token)
    UNION ALL
    SELECT DISTINCT recipe_id, 'ing_' || token
    FROM (SELECT recipe_id, unnest(string_split(ingredients_clean, ' ')) AS token FROM merged)
      JOIN ings USING (token))
  GROUP BY recipe_id)"""

TRAINING = f"""WITH {FULL}, {SCALED}, {VOCABS}, {INDICATORS}
SELECT s.recipe_id, name, tags_clean, ingredients_clean, {clean("size")}, {clean("price")},
  {clean("raw_mean_rating")}, review_count, {clean("bayesian_rating")},
  {", ".join([clean(f"pred_{t}") for t in TAGS] + [clean(f"intensity_{t}") for t in TAGS])}, indicators
FROM scaled s JOIN shown USING (recipe_id)"""

# Vectors of all items: meta is size, price, then indicators by vocabulary order; then tags.
FEATURE_LIST = f"""places AS (
  SELECT 'size' AS feature, 1 AS part, 1 AS place UNION ALL SELECT 'price', 1, 2
  UNION ALL SELECT 'cat_' || token, 2, place FROM cats
  UNION ALL SELECT 'ing_' || token, 3, place FROM ings
  {" ".join(f"UNION ALL SELECT 'pred_{t}', 4, {i}" for i, t in enumerate(TAGS))}
  {" ".join(f"UNION ALL SELECT 'intensity_{t}', 5, {i}" for i, t in enumerate(TAGS))}),
numbered AS (SELECT feature, CAST(row_number() OVER (ORDER BY part, place) - 1 AS INTEGER) AS idx FROM places)"""

TAG_CASES = " ".join(
    f"WHEN 'pred_{t}' THEN pred_{t} WHEN 'intensity_{t}' THEN intensity_{t}" for t in TAGS
)
VECTORS = f"""cells AS (
  SELECT s.recipe_id, s.name, s.bayesian_rating, idx, feature,
    CASE feature WHEN 'size' THEN size WHEN 'price' THEN price {TAG_CASES}
      ELSE CAST(list_contains(string_split(CASE WHEN feature LIKE 'cat\\_%' ESCAPE '\\'
        THEN tags_clean ELSE ingredients_clean END, ' '), substr(feature, 5)) AS DOUBLE) END AS value
  FROM scaled s, numbered)"""
ASSEMBLED = f"{FULL}, {SCALED}, {VOCABS}, {FEATURE_LIST}, {VECTORS}"

# The scoring network with a hidden width of 8 and weights by rule.
SCALE = "sqrt(1.0 + 1e-5)"


def linear(source: str, width: int, n_in: int) -> str:
    """Rows (recipe_id, i, x) through a linear layer without bias."""
    weight = f"(((o * 31 + i * 17) % 13 - 6) / {16.0 if n_in <= 16 else 64.0}::DOUBLE)"
    return f"SELECT recipe_id, o AS i, sum(x * {weight}) AS x FROM {source}, range({width}) r(o) GROUP BY recipe_id, o"


def dense(name: str, source: str, width: int, n_in: int) -> str:
    return f"{name} AS (SELECT recipe_id, i, greatest(0.0, x / {SCALE}) AS x FROM ({linear(source, width, n_in)}))"


def block(name: str, source: str, n: int, middle: int) -> str:
    """Two layers whose result is added to their input."""
    return f"""{dense(name + "_a", source, middle, n)},
{name} AS (SELECT recipe_id, i, greatest(0.0, y.x / {SCALE} + s.x) AS x
  FROM ({linear(name + "_a", n, middle)}) y JOIN {source} s USING (recipe_id, i))"""


def norm(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT recipe_id, i, (x - m) / sqrt(v + 1e-5) AS x
  FROM {source} JOIN (SELECT recipe_id, avg(x) AS m, var_pop(x) AS v FROM {source} GROUP BY recipe_id) USING (recipe_id))"""


# The layers of each head.
HEAD_LAYERS = {
    "shallow": ["full"],
    "deep": ["full"] * 10,
    "residual": ["full"] + ["plain"] * 2 + ["full"],
    "residual_v2": ["full"] + ["wide"] * 6 + ["full"],
    "residual_v3": ["full"] + ["wide"] * 6 + ["full"],
    "two_tower": ["full"] + ["wide"] * 6 + ["full"],
}
CATS = "(SELECT count(*) FROM cats) + (SELECT count(*) FROM ings)"

NETWORK_INPUT = f"""meta_in AS (
  SELECT recipe_id, idx AS i, CAST(CAST(value AS FLOAT) AS DOUBLE) AS x FROM cells
  WHERE feature NOT LIKE 'pred%' AND feature NOT LIKE 'intensity%'),
tag_in AS (
  SELECT recipe_id, idx - 2 - ({CATS}) AS i, CAST(CAST(value AS FLOAT) AS DOUBLE) AS x FROM cells
  WHERE feature LIKE 'pred%' OR feature LIKE 'intensity%')"""


def network(head: str, meta_width: int) -> str:
    """CTEs from the vectors to ``<head>_bundle (recipe_id, prediction, width, total)``."""
    p = f"{head}_"
    parts = [dense(p + "t1", "tag_in", 8, 6), dense(p + "t2", p + "t1", 8, 8)]
    if head == "two_tower":
        parts += [dense(p + "m1", "meta_in", 4, meta_width), dense(p + "m2", p + "m1", 2, 4)]
        source, n = p + "t2", 8
    elif head == "residual_v3":
        parts += [
            f"""{p}bins AS (
  SELECT recipe_id, i * 16 + m AS i,
    sum(greatest(0, 1 - abs(x - (-3 + n * 6.0::DOUBLE / 14)) / (6.0::DOUBLE / 14)) * ((i * 7 + n * 31 + m * 17) % 13 - 6) / 16.0::DOUBLE) AS x
  FROM meta_in, range(15) a(n), range(16) b(m) WHERE i < 2 GROUP BY recipe_id, i, m),
{p}classes AS (SELECT recipe_id, i - 2 AS i, x FROM meta_in WHERE i >= 2)""",
            dense(p + "m1", p + "bins", 4, 32),
            dense(p + "c1", p + "classes", 4, meta_width - 2),
            f"{p}m2 AS (SELECT * FROM {p}m1 UNION ALL SELECT recipe_id, i + 4, x FROM {p}c1)",
        ]
    else:
        parts += [dense(p + "m1", "meta_in", 8, meta_width), dense(p + "m2", p + "m1", 8, 8)]
    if head != "two_tower":
        parts.append(f"{p}fused AS (SELECT * FROM {p}m2 UNION ALL SELECT recipe_id, i + 8, x FROM {p}t2)")
        source, n = p + "fused", 16
    kinds = HEAD_LAYERS[head]
    for number, kind in enumerate(kinds):
        name = f"{p}h{number}"
        if kind == "full":
            parts.append(dense(name, source, 8 if number == len(kinds) - 1 else n, n))
        else:
            parts.append(block(name, source, n, n if kind == "plain" else 2 * n))
        source = name
    if head == "two_tower":
        parts += [
            norm(p + "mn", p + "m2"),
            norm(p + "tn", source),
            f"{p}emb AS (SELECT * FROM {p}mn UNION ALL SELECT recipe_id, i + 2, x FROM {p}tn)",
            f"{p}hidden AS (SELECT recipe_id, i, greatest(0.0, x) AS x FROM ({linear(p + 'emb', 64, 10)}))",
        ]
        source, output = p + "emb", linear(p + "hidden", 1, 64)
    else:
        output = linear(source, 1, 8)
    parts.append(f"""{p}bundle AS (
  SELECT recipe_id, 1 + 4 / (1 + exp(-raw)) AS prediction, width, total
  FROM (SELECT recipe_id, x AS raw FROM ({output}))
    JOIN (SELECT recipe_id, CAST(count(*) AS INTEGER) AS width, sum(x) AS total FROM {source} GROUP BY recipe_id)
    USING (recipe_id))""")
    # Each step once: the later ones read it several times.
    return ",\n".join(parts).replace(" AS (", " AS MATERIALIZED (")


META_WIDTH = 49  # 2 numbers and the test tables' vocabulary: only whether it is above 16 matters
SHALLOW = f"{NETWORK_INPUT}, {network('shallow', META_WIDTH)}"


def bundle(head: str) -> str:
    return f"""SELECT recipe_id, name AS recipe_name, round(CAST(CAST(bayesian_rating AS FLOAT) AS DOUBLE), 4) AS target,
  {clean("prediction")}, width, round(total, 4) + 0.0 AS total
FROM {head}_bundle JOIN scaled USING (recipe_id)"""


BUNDLE = f"WITH {ASSEMBLED}, {SHALLOW}\n{bundle('shallow')}"
OTHER_HEADS = [h for h in HEAD_LAYERS if h != "shallow"]
HEADS = f"WITH {ASSEMBLED}, {NETWORK_INPUT}, {', '.join(network(h, META_WIDTH) for h in OTHER_HEADS)}\n" + (
    " UNION ALL ".join(f"SELECT '{h}' AS head, * FROM ({bundle(h)})" for h in OTHER_HEADS)
)

# The rating model: moments of the training rows, and Gaussian elimination for each regularisation.
FITTED = f"""WITH RECURSIVE {ASSEMBLED},
placed AS (
  SELECT recipe_id, CAST(CAST(bayesian_rating AS FLOAT) AS DOUBLE) AS target,
    row_number() OVER (ORDER BY md5(recipe_id || ':42'), recipe_id) AS place, count(*) OVER () AS n FROM scaled),
labelled AS (
  SELECT recipe_id, target, ln((inside - 1) / 4 / (1 - (inside - 1) / 4)) AS y,
    CASE WHEN place <= floor(0.7::DOUBLE * n) THEN 'train'
      WHEN place <= floor(0.7::DOUBLE * n) + floor(0.15::DOUBLE * n) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, greatest(1.001::DOUBLE, least(4.999::DOUBLE, target)) AS inside FROM placed)),
x AS MATERIALIZED (SELECT recipe_id, idx, CAST(CAST(value AS FLOAT) AS DOUBLE) AS v FROM cells),
features AS MATERIALIZED (
  SELECT idx, avg(v) AS mean, stddev_samp(v) AS sd, row_number() OVER (ORDER BY idx) AS k
  FROM x JOIN labelled USING (recipe_id) WHERE split = 'train' GROUP BY idx HAVING stddev_samp(v) > 1e-12),
ys AS (SELECT avg(y) AS ymean, count(*) - 1 AS df FROM labelled WHERE split = 'train'),
z AS MATERIALIZED (SELECT recipe_id, k, (v - mean) / sd AS z FROM x JOIN features USING (idx)),
train AS MATERIALIZED (SELECT z.*, y - ymean AS dy FROM z JOIN labelled USING (recipe_id), ys WHERE split = 'train'),
regs AS (SELECT unnest([0.001::DOUBLE, 0.01::DOUBLE, 0.1::DOUBLE]) AS reg_param),
products AS MATERIALIZED (
  SELECT a.k AS i, b.k AS j, sum(a.z * b.z) / any_value(df) AS r FROM train a JOIN train b USING (recipe_id), ys GROUP BY ALL
  UNION ALL SELECT k, 1000000, sum(z * dy) / any_value(df) FROM train, ys GROUP BY k),
augmented AS (SELECT reg_param, i, list(r + CASE WHEN i = j THEN reg_param ELSE 0 END ORDER BY j) AS cells FROM products, regs GROUP BY ALL),
elimination AS (
  SELECT reg_param, CAST(0 AS BIGINT) AS k, list(cells ORDER BY i) AS m, count(*) AS size FROM augmented GROUP BY reg_param
  UNION ALL
  SELECT reg_param, k + 1, list_transform(m, lambda row, i: CASE WHEN i = k + 1 THEN list_transform(row, lambda c: c / row[k + 1])
    ELSE list_transform(row, lambda c, j: c - row[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END), size
  FROM elimination WHERE k < size),
solved AS (
  SELECT reg_param, unnest(list_transform(m, lambda row: row[-1])) AS b, unnest(range(1, size + 1)) AS k FROM elimination WHERE k = size),
fitted AS MATERIALIZED (
  SELECT reg_param, split, any_value(target) AS target, 1 + 4 / (1 + exp(-(any_value(ymean) + sum(b * z)))) AS prediction
  FROM z JOIN solved USING (k) JOIN labelled USING (recipe_id), ys WHERE split <> 'train' GROUP BY reg_param, split, recipe_id),
losses AS (
  SELECT reg_param, avg((prediction - target) ** 2) FILTER (WHERE split = 'val') AS validation_loss,
    avg((prediction - target) ** 2) FILTER (WHERE split = 'test') AS test_mse, avg(abs(prediction - target)) FILTER (WHERE split = 'test') AS test_mae
  FROM fitted GROUP BY reg_param),
history AS (SELECT *, row_number() OVER (ORDER BY validation_loss, reg_param) = 1 AS chosen FROM losses)"""

# --- retrieval -----------------------------------------------------------------------------------


def postings(source: str, doc: str, text: str) -> str:
    return f"""words AS (
  SELECT {doc} AS doc_id, list_filter(regexp_split_to_array(lower({text}), '\\s+'), lambda t: t <> '') AS toks
  FROM {source}),
lengths AS (SELECT doc_id, CAST(len(toks) AS BIGINT) AS dl FROM words WHERE len(toks) > 0),
postings AS (
  SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM words) GROUP BY term, doc_id),
frequencies AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
corpus AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM lengths)"""


def bm25(query_source: str, pool: int) -> str:
    return f"""asked AS (
  SELECT DISTINCT query_id, term FROM (
    SELECT query_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS term FROM {query_source}) WHERE term <> ''),
lexical_scores AS (
  SELECT query_id, doc_id, round(sum(
    ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
  FROM asked JOIN postings USING (term) JOIN frequencies USING (term) JOIN lengths USING (doc_id), corpus
  GROUP BY query_id, doc_id),
lexical_hits AS (
  SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM lexical_scores QUALIFY rank <= {pool})"""


TEXT_QUERIES = """text_queries AS (
  SELECT item_id AS query_id, text FROM benchmark)"""

DOCUMENT_POSTINGS = postings("documents", "doc_id", "text")

ITEM_QUERIES = """item_queries AS (
  SELECT CAST(p_partkey AS BIGINT) AS query_id, p_name AS text, CAST(embedding AS DOUBLE[]) AS vector,
    CAST(p_partkey % (SELECT count(*) FROM customer) AS VARCHAR) AS user_id
  FROM part JOIN embeddings ON vec_id = p_partkey % (SELECT count(*) FROM embeddings) WHERE p_partkey % 20 = 0)"""

SEARCHABLE = """searchable AS (
  SELECT l.*, name, name AS text, CAST(embedding AS DOUBLE[]) AS embedding
  FROM level l JOIN items USING (recipe_id)
    JOIN embeddings ON vec_id = CAST(recipe_id AS BIGINT) % (SELECT count(*) FROM embeddings))"""

AFFINITY = "list_cosine_similarity([bulk, open, returned], [intensity_bulk, intensity_open, intensity_returned])"


def search_signals(affinity: str = "0.0::DOUBLE", more: str = "", profile: str = "") -> str:
    return f"""{FULL}, {ITEM_QUERIES}, {SEARCHABLE}, {postings("searchable", "recipe_id", "text")},
{bm25("item_queries", 100)}, {more}
signals AS (
  SELECT query_id, s.recipe_id, s.name, h.score AS lexical,
    list_cosine_similarity(q.vector, s.embedding) AS semantic,
    greatest(0, least(1, (bayesian_rating - 1) / 4)) AS quality, intensity_open - intensity_returned AS tag, {affinity} AS affinity
  FROM lexical_hits h JOIN searchable s ON s.recipe_id = h.doc_id JOIN item_queries q USING (query_id) {profile})"""


def blended(source: str, weights: dict[str, float], key: str = "query_id", top_k: int = 10) -> str:
    total = sum(weights.values())
    parts = " + ".join(
        f"{w / total!r}::DOUBLE * CASE WHEN max({s}) OVER q > min({s}) OVER q"
        f" THEN ({s} - min({s}) OVER q) / (max({s}) OVER q - min({s}) OVER q) ELSE 0 END"
        for s, w in weights.items()
    )
    return f"""scored AS (
  SELECT {key}, recipe_id, name, round({parts}, 6) + 0.0 AS score FROM {source} WINDOW q AS (PARTITION BY {key})),
ranked AS (
  SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY score DESC, recipe_id) AS INTEGER) AS rank,
    recipe_id, name, score
  FROM scored QUALIFY rank <= {top_k})"""


def search(weights: dict[str, float]) -> str:
    return f"""WITH {search_signals()}, {blended("signals", weights)}
SELECT query_id, rank, recipe_id, name, score FROM ranked"""


WEIGHTS = {"lexical": 0.4, "semantic": 0.3, "quality": 0.2, "tag": 0.1, "affinity": 0.2}

SEARCH_SEMANTIC = f"""WITH {FULL}, {ITEM_QUERIES}, {SEARCHABLE},
pool AS (
  SELECT query_id, recipe_id, name, round(list_cosine_similarity(vector, embedding), 6) AS semantic
  FROM item_queries, searchable
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY semantic DESC, recipe_id) <= 100),
{blended("pool", {"semantic": 1.0})}
SELECT query_id, rank, recipe_id, name, score FROM ranked"""

BM25 = f"""WITH {DOCUMENT_POSTINGS}, {TEXT_QUERIES}, {bm25("text_queries", 100)}
SELECT query_id, doc_id, score, rank FROM lexical_hits"""
BM25_10 = f"""WITH {DOCUMENT_POSTINGS}, {TEXT_QUERIES}, {bm25("text_queries", 10)}
SELECT query_id, doc_id, score, rank FROM lexical_hits"""

def semantic(asked: str) -> str:
    return f"""WITH asked AS ({asked}),
scores AS (
  SELECT query_id, vec_id AS recipe_id, round(list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])), 6) + 0.0 AS score
  FROM asked, embeddings)
SELECT query_id, recipe_id, score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, recipe_id) AS INTEGER) AS rank
FROM scores QUALIFY rank <= 10"""


EVERY_VECTOR = "SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings"
SEMANTIC = semantic(EVERY_VECTOR)
# A supplier whose key is its vector's asks the question of that vector.
SEMANTIC_OF_SUPPLIERS_TOO = semantic(f"""{EVERY_VECTOR} UNION ALL
  SELECT s_suppkey, CAST(embedding AS DOUBLE[]) FROM supplier JOIN embeddings ON vec_id = s_suppkey % (SELECT count(*) FROM embeddings)
  WHERE s_suppkey <> vec_id""")

# --- users ---------------------------------------------------------------------------------------

IDF = f"""idf AS (
  {" UNION ALL ".join(f"SELECT '{t}' AS tag, avg(CAST(pred_{t} AS DOUBLE)) AS prevalence FROM reviews" for t in TAGS)}),
weights AS (SELECT tag, prevalence, CASE WHEN prevalence > 0 THEN ln(1 / prevalence) ELSE 0 END AS idf FROM idf)"""

PROFILES = f"""{IDF},
history AS (
  SELECT user_id, recipe_id, rating - avg(rating) OVER (PARTITION BY user_id) AS dev, rating,
    pow(0.5, date_diff('day', ts, max(ts) OVER ()) / 365.0) AS w
  FROM reviews),
profiles AS (
  SELECT user_id, count(*) AS n_reviews, avg(rating) AS mean_rating,
    {", ".join(
        f"(SELECT idf FROM weights WHERE tag = '{t}') * sum(w * dev * coalesce(intensity_{t}, 0)) / sum(w) AS {t}"
        for t in TAGS)}
  FROM history LEFT JOIN level USING (recipe_id) GROUP BY user_id)"""

CUTOFF = """cutoff AS (SELECT quantile_cont(epoch_us(ts), 0.8) AS c FROM reviews),
timed AS (SELECT reviews.*, CASE WHEN epoch_us(ts) <= c THEN 'train' ELSE 'test' END AS split FROM reviews, cutoff)"""

POPULAR = f"""{LEVEL}, {CUTOFF},
recommended AS (
  SELECT user_id, recipe_id, round(bayesian_rating, 6) AS score,
    row_number() OVER (PARTITION BY user_id ORDER BY round(bayesian_rating, 6) DESC, recipe_id) AS rank
  FROM (SELECT DISTINCT user_id, recipe_id FROM timed WHERE split = 'train') JOIN level USING (recipe_id)
  QUALIFY rank <= 5),
liked AS (SELECT DISTINCT user_id, recipe_id, 1 AS hit FROM timed WHERE split = 'test' AND rating >= 4)"""

CO_RATED = """devs AS (SELECT user_id, recipe_id, rating - avg(rating) OVER (PARTITION BY user_id) AS dev FROM pairs),
co AS (
  SELECT a.recipe_id AS recipe_id, b.recipe_id AS neighbour, count(*) AS n, sum(a.dev * b.dev) AS dot,
    sqrt(sum(a.dev * a.dev)) * sqrt(sum(b.dev * b.dev)) AS size
  FROM devs a JOIN devs b ON a.user_id = b.user_id AND a.recipe_id <> b.recipe_id
  GROUP BY ALL HAVING count(*) >= 2),
neighbours AS (
  SELECT recipe_id, neighbour, round(CASE WHEN size > 0 THEN dot / size ELSE 0 END, 6) + 0.0 AS similarity,
    CAST(row_number() OVER (PARTITION BY recipe_id ORDER BY round(CASE WHEN size > 0 THEN dot / size ELSE 0 END, 6) DESC, neighbour) AS INTEGER) AS rank
  FROM co QUALIFY rank <= 20)"""

PAIRS = f"""{REVIEWS},
pairs AS (SELECT user_id, recipe_id, avg(rating) AS rating FROM reviews GROUP BY ALL),
{CO_RATED}"""

SESSIONS = """sessions AS (
  SELECT DISTINCT user_id AS session_id, event_id % (SELECT count(*) FROM embeddings) AS recipe_id
  FROM events WHERE event_type = 'purchase')"""


def mean_vector(source: str, key: str, vectors: str, item: str) -> str:
    return f"""means AS (
  SELECT {key}, list(m ORDER BY pos) AS vector FROM (
    SELECT {key}, pos, avg(CAST(v AS DOUBLE)) AS m FROM (
      SELECT {key}, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos
      FROM {source} JOIN {vectors} ON {vectors}.{item} = {source}.recipe_id)
    GROUP BY {key}, pos)
  GROUP BY {key})"""


def recommended(reviews: str, top_k: int, collaborative: bool, users: str) -> str:
    """CTEs up to ``recommendations (user_id, rank, recipe_id, name, score)`` for the ``users``."""
    listed = 20 if collaborative else top_k
    final = f"""fused AS (
  SELECT user_id, recipe_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) + 0.0 AS score
  FROM (SELECT user_id, recipe_id, rank FROM ranked UNION ALL SELECT user_id, recipe_id, rank FROM filtered) GROUP BY ALL),
final AS (
  SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, recipe_id) AS INTEGER) AS rank, recipe_id, name, score
  FROM fused JOIN items USING (recipe_id) QUALIFY rank <= {top_k})"""
    if not collaborative:
        final = "final AS (SELECT * FROM ranked)"
    return f"""{reviews}, {level()}, {ITEMS}, {MERGED}, {SEARCHABLE}, {PROFILES},
seeds AS (SELECT DISTINCT user_id, recipe_id FROM reviews),
{mean_vector("seeds", "user_id", "searchable", "recipe_id")},
near AS (
  SELECT user_id, s.recipe_id, s.name, round(list_cosine_similarity(vector, embedding), 6) + 0.0 AS semantic
  FROM means, searchable s
  WHERE NOT EXISTS (SELECT 1 FROM seeds d WHERE d.user_id = means.user_id AND d.recipe_id = s.recipe_id)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY semantic DESC, s.recipe_id) <= 20),
signals AS (
  SELECT user_id, recipe_id, n.name, 0.0::DOUBLE AS lexical, semantic,
    greatest(0, least(1, (bayesian_rating - 1) / 4)) AS quality, intensity_open - intensity_returned AS tag,
    coalesce({AFFINITY}, 0) AS affinity
  FROM near n JOIN searchable s USING (recipe_id) LEFT JOIN profiles USING (user_id)),
{blended("signals", WEIGHTS, "user_id", listed)},
{filtered(20) + "," if collaborative else ""}
{final},
best AS (
  SELECT recipe_id, name, round(greatest(0, least(1, (bayesian_rating - 1) / 4)), 6) AS score,
    CAST(row_number() OVER (ORDER BY round(greatest(0, least(1, (bayesian_rating - 1) / 4)), 6) DESC, recipe_id) AS INTEGER) AS rank
  FROM searchable QUALIFY rank <= {top_k}),
users AS ({users}),
recommendations AS (
  SELECT user_id, rank, recipe_id, name, score FROM final WHERE user_id IN (SELECT user_id FROM users)
  UNION ALL
  SELECT user_id, rank, recipe_id, name, score FROM users, best WHERE user_id NOT IN (SELECT user_id FROM final))"""


def filtered(k: int) -> str:
    return f"""pairs AS (
  SELECT user_id, recipe_id, avg(rating) AS rating FROM reviews WHERE recipe_id IN (SELECT recipe_id FROM searchable) GROUP BY ALL),
{CO_RATED},
estimates AS (
  SELECT user_id, n.recipe_id, round(sum(similarity * dev) / sum(abs(similarity)), 6) + 0.0 AS score
  FROM neighbours n JOIN devs d ON d.recipe_id = n.neighbour
  WHERE user_id IN (SELECT user_id FROM reviews GROUP BY user_id HAVING count(*) >= 5)
  GROUP BY user_id, n.recipe_id HAVING sum(abs(similarity)) > 0),
filtered AS (
  SELECT user_id, recipe_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, recipe_id) AS INTEGER) AS rank
  FROM estimates e WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.user_id = e.user_id AND p.recipe_id = e.recipe_id)
  QUALIFY rank <= {k})"""


CUSTOMERS = "SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer"

PAST = f"""{REVIEWS.replace("reviews AS (", "every AS (", 1)},
cutoff AS (SELECT quantile_cont(epoch_us(ts), 0.8) AS c FROM every),
timed AS (SELECT every.*, epoch_us(ts) <= c AS past FROM every, cutoff),
reviews AS (SELECT * EXCLUDE (past) FROM timed WHERE past),
truth AS (SELECT * FROM timed WHERE NOT past),
liked AS (SELECT DISTINCT user_id, recipe_id, 1 AS hit FROM truth WHERE rating >= 4)"""


def evaluation(collaborative: bool) -> str:
    return f"""WITH {recommended(PAST, 5, collaborative, "SELECT DISTINCT user_id FROM truth")},
dcg AS (SELECT user_id, sum(coalesce(hit, 0) / log2(rank + 1)) AS dcg FROM recommendations LEFT JOIN liked USING (user_id, recipe_id) GROUP BY user_id),
ideal AS (
  SELECT user_id, (SELECT sum(1 / log2(r + 1)) FROM range(1, 6) t(r) WHERE r <= n) AS best
  FROM (SELECT user_id, count(*) AS n FROM liked GROUP BY user_id)),
mass AS (
  SELECT user_id, unnest([sum(pred_bulk), sum(pred_open), sum(pred_returned)]) AS m,
    sum(pred_bulk) + sum(pred_open) + sum(pred_returned) AS total
  FROM recommendations JOIN level USING (recipe_id) GROUP BY user_id),
spread AS (SELECT -sum(CASE WHEN m > 0 THEN m / total * ln(m / total) ELSE 0 END) / ln(3) AS d FROM mass GROUP BY user_id)
SELECT (SELECT round(avg(coalesce(dcg / best, 0)), 6) FROM dcg LEFT JOIN ideal USING (user_id)) AS ndcg,
  (SELECT count(*) FROM dcg) AS n_users,
  (SELECT round(avg(CAST(coalesce(hit, 0) AS DOUBLE)), 6)
   FROM recommendations LEFT JOIN liked USING (user_id, recipe_id) WHERE rank = 1) AS precision_at_1,
  (SELECT round(avg(d), 6) FROM spread) AS diversity,
  (SELECT round((SELECT count(DISTINCT recipe_id) FROM recommendations) / (SELECT count(*) FROM part), 6)) AS coverage"""


RECOMMEND = f"WITH {recommended(REVIEWS, 10, False, CUSTOMERS)} SELECT * FROM recommendations"
RECOMMEND_COLLABORATIVE = f"WITH {recommended(REVIEWS, 10, True, CUSTOMERS)} SELECT * FROM recommendations"

# --- one entry per query ---------------------------------------------------------------------------

REPORT_COLUMNS = (
    ["size", "price", "raw_mean_rating", "review_count", "bayesian_rating"]
    + [f"pred_{t}" for t in TAGS]
    + [f"intensity_{t}" for t in TAGS]
)

PREDICTIONS = f"{LEVEL}, predictions AS (SELECT recipe_id, raw_mean_rating - bayesian_rating AS e FROM level)"

SPLIT = f"""{ITEMS},
placed AS (
  SELECT recipe_id, row_number() OVER (ORDER BY md5(recipe_id || ':42'), recipe_id) AS place,
    count(*) OVER () AS n FROM items),
splits AS (
  SELECT recipe_id, CASE WHEN place <= floor(0.7::DOUBLE * n) THEN 'train'
    WHEN place <= floor(0.7::DOUBLE * n) + floor(0.15::DOUBLE * n) THEN 'val' ELSE 'test' END AS split FROM placed)"""

ERRORS = f"""{PREDICTIONS}
SELECT {clean("mse")}, round(sqrt(mse), 6) AS rmse, {clean("mae")}"""

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

ORACLE: dict[str, str] = {
    "s1_load_inputs": """SELECT 'items' AS input, count(*) AS n FROM part
UNION ALL SELECT 'reviews', count(*) FROM lineitem UNION ALL SELECT 'labels', count(*) FROM lineitem""",
    "s2_reuse_training_table": TRAINING,
    "s3_search_table": f"""WITH {FULL}
SELECT recipe_id, name, replace(tags_clean, ' ', '|') AS tags_clean,
  replace(replace(ingredients_clean, ' ', '|'), '_', ' ') AS ingredients_clean, size, {clean("price")},
  {clean("raw_mean_rating")}, review_count, {clean("bayesian_rating")},
  {", ".join(f"pred_{t} <> 0 AS pred_{t}" for t in TAGS)},
  {", ".join(clean(f"intensity_{t}") for t in TAGS)}
FROM merged""",
    "s4_column_mapping": f"""WITH {FULL}, {VOCABS},
places AS (
  SELECT * FROM (VALUES ('tags_clean', 0, 0), ('ingredients_clean', 0, 1), ('size', 0, 2), ('price', 0, 3),
    {", ".join(f"('pred_{t}', 1, {i}), ('intensity_{t}', 2, {i})" for i, t in enumerate(TAGS))}) v(feature, part, place)
  UNION ALL SELECT 'cat_' || token, 3, place FROM cats UNION ALL SELECT 'ing_' || token, 4, place FROM ings)
SELECT feature, CAST(row_number() OVER (ORDER BY part, place) - 1 AS INTEGER) AS idx FROM places""",
    "s4_feature_index": f"WITH {FULL}, {VOCABS}, {FEATURE_LIST} SELECT feature, idx FROM numbered",
    "s5_training_table": TRAINING,
    "s6_embedding_bundle": BUNDLE,
    "s7_metrics_sink": f"""WITH {ERRORS} FROM (SELECT avg(e * e) AS mse, avg(abs(e)) AS mae FROM predictions)""",
    "p1_normalise_ids": f"""WITH raw AS (
  SELECT unnest([CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR), ' ' || l_partkey || ' ',
    '-' || l_suppkey || '.75', '+' || l_linenumber || 'e3', l_returnflag, l_suppkey || 'd']) AS raw_id
  FROM lineitem)
SELECT CAST(CAST(trunc(CASE WHEN regexp_matches(raw_id, '{NUMBER}') THEN CAST(trim(raw_id) AS DOUBLE) ELSE 0 END) AS BIGINT) AS VARCHAR)
  AS recipe_id, count(*) AS n
FROM raw GROUP BY 1""",
    "p2_discover_tags": " UNION ALL ".join(
        f"SELECT '{t}' AS tag, count(*) AS n FROM lineitem WHERE {c}"
        for t, c in (("returned", "l_returnflag = 'R'"), ("open", "l_linestatus = 'O'"), ("bulk", "l_quantity > 40"))
    ),
    "p3_recipe_level_columns": f"WITH {LEVEL} SELECT {LEVEL_COLUMNS} FROM level_rated",
    "p4_keep_signals": f"""WITH {RARE}, {level("rare", ("rare",))}
SELECT recipe_id, {clean("raw_mean_rating")}, review_count, {clean("bayesian_rating")},
  {clean("pred_rare")}, {clean("intensity_rare")} FROM level""",
    "p5_tags_to_boolean": f"""WITH {LEVEL}
SELECT recipe_id, {", ".join(f"pred_{t} <> 0 AS pred_{t}" for t in TAGS)} FROM level_all""",
    "p6_parse_tokens": f"""WITH {ITEMS}
SELECT recipe_id, replace(tags_clean, ' ', '|') AS tags_clean,
  replace(replace(ingredients_clean, ' ', '|'), '_', ' ') AS ingredients_clean FROM items""",
    "p6_tokens_of_documents": """SELECT doc_id,
  CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '')) AS BIGINT) AS n_tokens
FROM documents""",
    "p7_standard_columns": f"""WITH {FULL}
SELECT 'size' AS feature, count(size) AS n FROM merged UNION ALL SELECT 'price', count(price) FROM merged""",
    "p8_feature_groups": f"""WITH {FULL}, {VOCABS}, n AS (SELECT (SELECT count(*) FROM cats) + (SELECT count(*) FROM ings) AS c)
SELECT 'meta' AS feature_group, c + 2 AS width FROM n UNION ALL SELECT 'numeric', 2
UNION ALL SELECT 'categorical', c FROM n UNION ALL SELECT 'tag', 6""",
    "p9_assemble_vectors": f"""WITH {ASSEMBLED}
SELECT recipe_id, name, idx AS pos, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) + 0.0 AS value FROM cells""",
    "p10_ablation": f"""WITH {ASSEMBLED},
sums AS (
  SELECT recipe_id,
    round(sum(abs(CAST(CAST(value AS FLOAT) AS DOUBLE))) FILTER (WHERE feature NOT LIKE 'pred%' AND feature NOT LIKE 'intensity%'), 3) AS meta,
    round(sum(abs(CAST(CAST(value AS FLOAT) AS DOUBLE))) FILTER (WHERE feature LIKE 'pred%' OR feature LIKE 'intensity%'), 3) AS tag
  FROM cells GROUP BY recipe_id)
SELECT recipe_id, 'meta_only' AS ablation, meta, 0.0::DOUBLE AS tag FROM sums
UNION ALL SELECT recipe_id, 'tag_only', 0.0::DOUBLE, tag FROM sums
UNION ALL SELECT recipe_id, 'all_features', meta, tag FROM sums""",
    "p11_bounded_prediction": """SELECT l_orderkey, l_linenumber,
  round(1 + 4 / (1 + exp(-(l_extendedprice - 50000) / 10000)), 6) AS prediction FROM lineitem""",
    "p12_soft_bins": f"""WITH {FULL}, {SCALED}
SELECT recipe_id, CAST(i AS INTEGER) AS pos,
  round(greatest(0, 1 - abs(size - (-3 + i * 6.0::DOUBLE / 14)) / (6.0::DOUBLE / 14)), 6) + 0.0 AS weight
FROM scaled, range(15) r(i)""",
    "j1_merge": f"""WITH {FULL}
SELECT recipe_id, name, tags_clean, ingredients_clean, size, {clean("price")},
  {LEVEL_COLUMNS.removeprefix("recipe_id, ")} FROM merged""",
    "j2_overlap": f"""WITH {RARE}, {level("rare", ("rare",))}, {ITEMS}
SELECT (SELECT count(DISTINCT recipe_id) FROM items) AS left_ids,
  (SELECT count(DISTINCT recipe_id) FROM level) AS right_ids,
  (SELECT count(*) FROM (SELECT recipe_id FROM items INTERSECT SELECT recipe_id FROM level)) AS shared_ids""",
    "a1_rating_mean_count": f"WITH {LEVEL} SELECT recipe_id, {clean('raw_mean_rating')}, review_count FROM level_all",
    "a2_tag_shares": f"""WITH {LEVEL}
SELECT recipe_id, {", ".join(clean(f"pred_{t}") for t in TAGS)} FROM level_all""",
    "a3_tag_intensity": f"""WITH {LEVEL}
SELECT recipe_id, {", ".join(clean(f"intensity_{t}") for t in TAGS)} FROM level_all""",
    "a4_global_mean": f"WITH {REVIEWS} SELECT round(avg(rating), 6) AS global_mean_rating FROM reviews",
    "a5_count_threshold": f"WITH {LEVEL} SELECT round(m, 6) AS count_threshold FROM scalars",
    "a6_bayesian_rating": f"WITH {LEVEL} SELECT {LEVEL_COLUMNS} FROM level",
    "a6_bayesian_rating_given_threshold": f"""WITH {REVIEWS}, {level(m="any_value(10.0::DOUBLE)")}
SELECT recipe_id, {clean("bayesian_rating")} FROM level""",
    "a7_feature_report": f"WITH {FULL} "
    + " UNION ALL ".join(
        f"""SELECT (SELECT count(DISTINCT recipe_id) FROM merged) AS items, CAST({len(REPORT_COLUMNS)} AS BIGINT) AS numeric_columns,
  '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM merged"""
        for c in REPORT_COLUMNS
    ),
    "a8_top_tokens": f"WITH {ITEMS}, {vocabulary('v', 'items', 'ingredients_clean', 20)} SELECT token, n FROM v",
    "a8_top_words_of_documents": """SELECT token, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS token FROM documents) WHERE token <> ''
GROUP BY token ORDER BY n DESC, token LIMIT 100""",
    "a9_standardise": f"WITH {FULL}, {SCALED} SELECT recipe_id, {clean('size')}, {clean('price')} FROM scaled",
    "a10_minmax": f"""WITH {FULL}, {SCALED}
SELECT recipe_id, {", ".join(clean(f"intensity_{t}") for t in TAGS)} FROM scaled""",
    "a11_indicators": f"""WITH {ITEMS}, {vocabulary("v", "items", "ingredients_clean", 100)}
SELECT recipe_id, 'ing_' || token AS feature,
  CAST(list_contains(string_split(ingredients_clean, ' '), token) AS INTEGER) AS value FROM items, v""",
    "a11_indicators_long": f"""WITH {ITEMS}, {vocabulary("v", "items", "tags_clean", 100)}
SELECT recipe_id, 'cat_' || token AS feature FROM items, v WHERE list_contains(string_split(tags_clean, ' '), token)""",
    "a12_losses": f"""WITH {PREDICTIONS}
SELECT round(avg(e * e), 6) AS mse, round(avg(CASE WHEN abs(e) <= 1 THEN e * e / 2 ELSE abs(e) - 0.5 END), 6) AS huber,
  round(avg(ln((exp(e + 1e-12) + exp(-e - 1e-12)) / 2)), 6) AS log_cosh FROM predictions""",
    "a13_evaluate": f"""WITH {ERRORS} FROM (SELECT avg(e * e) AS mse, avg(abs(e)) AS mae FROM predictions)""",
    "a13_evaluate_batched": f"""WITH {ERRORS} FROM (
  SELECT avg(mse) AS mse, avg(mae) AS mae FROM (
    SELECT avg(e * e) AS mse, avg(abs(e)) AS mae FROM (
      SELECT e, (row_number() OVER (ORDER BY md5(recipe_id || ':42'), recipe_id) - 1) // 256 AS batch FROM predictions)
    GROUP BY batch))""",
    "a14_output_profile": f"""WITH {ASSEMBLED}, {SHALLOW}
SELECT round(min(prediction), 6) AS min_prediction, round(max(prediction), 6) AS max_prediction,
  count(*) AS rows, max(width) AS width FROM shallow_bundle""",
    "a15_split_sizes": f"WITH {SPLIT} SELECT split, count(*) AS n FROM splits GROUP BY split",
    "x1_split": f"WITH {SPLIT} SELECT recipe_id, split FROM splits",
    "m1_score_corpus": BUNDLE,
    "m1_heads": HEADS,
    "q1_preprocess": TRAINING,
    "q2_train": f"""{FITTED}
SELECT 'linear_logit' AS model_type, 'all_features' AS ablation_type, 'mse' AS loss_type,
  round(test_mse, 5) AS test_mse, round(sqrt(test_mse), 5) AS test_rmse, round(test_mae, 5) AS test_mae FROM history WHERE chosen""",
    "m2_fit_rating_model": f"""{FITTED}
SELECT reg_param, round(validation_loss, 5) AS validation_loss, chosen, round(max(test_mse) FILTER (WHERE chosen) OVER (), 5) AS test_mse,
  round(sqrt(max(test_mse) FILTER (WHERE chosen) OVER ()), 5) AS test_rmse, round(max(test_mae) FILTER (WHERE chosen) OVER (), 5) AS test_mae
FROM history""",
    "m3_item_vectors": f"""WITH {ASSEMBLED},
x AS (SELECT recipe_id, idx, CAST(CAST(value AS FLOAT) AS DOUBLE) AS v FROM cells),
m AS (SELECT idx, avg(v) AS mean FROM x GROUP BY idx)
SELECT recipe_id, CAST(least(128, count(*)) AS INTEGER) AS width, round(sqrt(sum((v - mean) * (v - mean))), 3) + 0.0 AS norm
FROM x JOIN m USING (idx) GROUP BY recipe_id""",
    "m3_explained_variance": f"""WITH {ASSEMBLED},
x AS (SELECT idx, var_samp(CAST(CAST(value AS FLOAT) AS DOUBLE)) AS v FROM cells GROUP BY idx)
SELECT count(*) AS components, round(sum(v), 4) AS variance, 1.0::DOUBLE AS share FROM x""",
    "q3_score": f"""WITH {ASSEMBLED}, {SHALLOW}
SELECT recipe_id, name AS recipe_name, round(CAST(CAST(bayesian_rating AS FLOAT) AS DOUBLE), 4) AS target,
  round(prediction, 3) + 0.0 AS prediction, width FROM shallow_bundle JOIN scaled USING (recipe_id)""",
    "d1_index_postings": f"""WITH {DOCUMENT_POSTINGS}
SELECT term, doc_id, tf, dl FROM postings JOIN lengths USING (doc_id)""",
    "d1_index_corpus": f"WITH {DOCUMENT_POSTINGS} SELECT n_docs, round(avgdl, 6) AS avgdl FROM corpus",
    "d1_index_document_frequencies": f"WITH {DOCUMENT_POSTINGS} SELECT term, df FROM frequencies",
    "d1_index_stored": BM25_10,
    "d1_index_grown": BM25_10,
    "d2_bm25": BM25,
    "d2_bm25_bounded": BM25,
    "d3_semantic": SEMANTIC_OF_SUPPLIERS_TOO,
    "d3_index_exact": SEMANTIC,
    "d4_quality": f"""WITH {LEVEL}
SELECT recipe_id, round(greatest(0, least(1, (bayesian_rating - 1) / 4)), 6) AS quality FROM level""",
    "d5_combine_hybrid": search(WEIGHTS),
    "d5_combine_without_semantic": search({s: w for s, w in WEIGHTS.items() if s != "semantic"}),
    "d6_cold_start": f"""WITH {REVIEWS}
SELECT CAST(c_custkey AS VARCHAR) AS user_id, CASE WHEN coalesce(n, 0) >= 5 THEN 1.0::DOUBLE ELSE 0.0 END AS affinity_score
FROM customer LEFT JOIN (SELECT user_id, count(*) AS n FROM reviews GROUP BY user_id) ON user_id = CAST(c_custkey AS VARCHAR)""",
    "d7_session_neighbours": f"""WITH {SESSIONS}, {mean_vector("sessions", "session_id", "embeddings", "vec_id")},
scores AS (
  SELECT session_id, vec_id AS recipe_id, round(list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])), 6) + 0.0 AS score
  FROM means, embeddings
  WHERE NOT EXISTS (SELECT 1 FROM sessions s WHERE s.session_id = means.session_id AND s.recipe_id = vec_id))
SELECT session_id, recipe_id, score,
  CAST(row_number() OVER (PARTITION BY session_id ORDER BY score DESC, recipe_id) AS INTEGER) AS rank
FROM scores QUALIFY rank <= 10""",
    "d8_tag_weights": f"WITH {REVIEWS}, {IDF} SELECT tag, {clean('prevalence')}, {clean('idf')} FROM weights",
    "d9_affinity_vectors": f"WITH {LEVEL}, {PROFILES} "
    + " UNION ALL ".join(
        f"SELECT user_id, '{t}' AS tag, round({t}, 6) + 0.0 AS value FROM profiles" for t in TAGS
    ),
    "d10_user_profiles": f"""WITH {LEVEL}, {PROFILES}
SELECT user_id, n_reviews, {clean("mean_rating")}, {", ".join(clean(t) for t in TAGS)} FROM profiles""",
    "d10_profiles_in_parts": f"""WITH {LEVEL}, {PROFILES}
SELECT user_id, n_reviews, {clean("mean_rating")}, {", ".join(clean(t) for t in TAGS)} FROM profiles""",
    "d11_affinity_scores": f"""WITH {LEVEL}, {PROFILES}
SELECT user_id, recipe_id, round(coalesce({AFFINITY}, 0), 5) + 0.0 AS affinity_score
FROM (SELECT DISTINCT user_id, recipe_id FROM reviews) LEFT JOIN profiles USING (user_id) LEFT JOIN level USING (recipe_id)""",
    "d12_tag_polarity": f"""WITH {REVIEWS}, {IDF}
SELECT tag, {clean("prevalence")}, {clean("idf")},
  CAST(CASE tag WHEN 'open' THEN 1 WHEN 'returned' THEN -1 ELSE 0 END AS INTEGER) AS polarity FROM weights""",
    "d12_net_sentiment": f"""WITH {LEVEL}
SELECT recipe_id, round(intensity_open - intensity_returned, 6) + 0.0 AS tag FROM level""",
    "d13_active_users": f"""WITH {REVIEWS}
SELECT user_id, count(*) AS n_reviews FROM reviews GROUP BY user_id HAVING count(*) >= 5""",
    "d14_item_similarities": f"WITH {PAIRS} SELECT recipe_id, neighbour, similarity, rank FROM neighbours",
    "d14_collaborative_filter": f"""WITH {PAIRS},
estimates AS (
  SELECT user_id, n.recipe_id, round(sum(similarity * dev) / sum(abs(similarity)), 6) + 0.0 AS score
  FROM neighbours n JOIN devs d ON d.recipe_id = n.neighbour
  WHERE user_id IN (SELECT user_id FROM reviews GROUP BY user_id HAVING count(*) >= 5)
  GROUP BY user_id, n.recipe_id HAVING sum(abs(similarity)) > 0),
unseen AS (SELECT * FROM estimates e WHERE NOT EXISTS (
  SELECT 1 FROM pairs p WHERE p.user_id = e.user_id AND p.recipe_id = e.recipe_id))
SELECT user_id, recipe_id, score,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, recipe_id) AS INTEGER) AS rank
FROM unseen QUALIFY rank <= 10""",
    "d15_temporal_split": f"""WITH {REVIEWS}, {CUTOFF}
SELECT split, count(*) AS n, CAST(max(ts) AS DATE) AS latest FROM timed GROUP BY split""",
    "d16_ndcg": f"""WITH {POPULAR},
dcg AS (SELECT user_id, sum(coalesce(hit, 0) / log2(rank + 1)) AS dcg FROM recommended LEFT JOIN liked USING (user_id, recipe_id) GROUP BY user_id),
ideal AS (
  SELECT user_id, (SELECT sum(1 / log2(r + 1)) FROM range(1, 6) t(r) WHERE r <= n) AS best
  FROM (SELECT user_id, count(*) AS n FROM liked GROUP BY user_id))
SELECT user_id, round(coalesce(dcg / best, 0), 6) + 0.0 AS ndcg FROM dcg LEFT JOIN ideal USING (user_id)""",
    "d17_precision_at_1": f"""WITH {POPULAR}
SELECT round(avg(CAST(coalesce(hit, 0) AS DOUBLE)), 6) AS precision_at_1
FROM recommended LEFT JOIN liked USING (user_id, recipe_id) WHERE rank = 1""",
    "d18_tag_diversity": f"""WITH {POPULAR},
mass AS (
  SELECT user_id, unnest([sum(pred_bulk), sum(pred_open), sum(pred_returned)]) AS m,
    sum(pred_bulk) + sum(pred_open) + sum(pred_returned) AS total
  FROM recommended JOIN level USING (recipe_id) GROUP BY user_id)
SELECT user_id, round(-sum(CASE WHEN m > 0 THEN m / total * ln(m / total) ELSE 0 END) / ln(3), 6) + 0.0 AS diversity
FROM mass GROUP BY user_id""",
    "d19_coverage": f"""WITH {POPULAR}
SELECT round((SELECT count(DISTINCT recipe_id) FROM recommended) / (SELECT count(*) FROM part), 6) AS coverage""",
    "d20_search_lexical": search({"lexical": 1.0}),
    "d20_search_semantic": SEARCH_SEMANTIC,
    "d20_search_quality": search({"lexical": 0.5, "quality": 0.5}),
    "d20_search_history": f"""WITH {search_signals(f"coalesce({AFFINITY}, 0)", PROFILES + ",", "LEFT JOIN profiles USING (user_id)")}, {blended("signals", WEIGHTS)}
SELECT query_id, rank, recipe_id, name, score FROM ranked""",
    "d20_recommend": RECOMMEND,
    "d20_recommend_collaborative": RECOMMEND_COLLABORATIVE,
    "d20_evaluate": evaluation(False),
    "d20_evaluate_collaborative": evaluation(True),
}
