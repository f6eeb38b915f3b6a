"""Model queries (K1-K10, E16) and their inputs.

Labelled text: documents joined to labels, de-duplicated on (text, label), cleaned and
hashed into TF-IDF vectors. Tabular classification: three numeric features per labelled
document (``tabular_table``). Points for clustering: ``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import tables as T
from kestrel.functions import text as X
from kestrel.operators import evaluation as E
from kestrel.operators import features as V
from kestrel.operators import models as M
from kestrel.operators import naive_bayes as NB
from kestrel.operators import trees as TR
from kestrel.operators.sampling import exact_split, random_split, split_threshold
from kestrel.plans.catalog import register
from kestrel.plans.q_text import TOKENS_SQL

SPLIT_SEED = 0
TREE_SEED = 42
KMEANS_K, KMEANS_SEED = 4, 13
HASHED_FEATURES = 1 << 18  # the Spark ML default
TREE_DEPTH, FOREST_TREES = 5, 20
BROADCAST_ROWS = 100_000  # keys of texts that are broadcast (counted)
FOREST_SUBSET = HASHED_FEATURES ** -0.5  # the square root of the features at each node


def labelled_docs(spark, sf_dir):
    """A3 on (text, label), keeping the smallest doc_id as the row key.

    Equal texts are found by their SHA-256, so no task holds a table of texts; the texts of
    the rows that stay stream past a small table of their keys."""
    digest = F.coalesce(F.sha2("text", 256), F.lit("")).alias("_digest")
    docs = T.documents(spark, sf_dir).select("doc_id", "text")
    labels = T.load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    firsts = M.materialize(docs.select("doc_id", digest).join(labels, "doc_id")
                           .groupBy("_digest", "label").agg(F.min("doc_id").alias("doc_id")))
    on = ["doc_id"]
    if V.has_repeats(docs, "doc_id"):  # rows that come twice, or texts that share a key
        on = ["doc_id", "_digest"]
        docs = docs.select("*", digest).dropDuplicates(on)
    kept = firsts.select(*on, "label")
    kept = F.broadcast(kept) if firsts.count() <= BROADCAST_ROWS else kept.hint("shuffle_hash")
    return docs.join(kept, on).select("text", "label", "doc_id")


def clean_labelled_tokens(spark, sf_dir):
    """(doc_id, label, split, clean_tokens): A3 -> T8 -> R1, checkpointed once; every
    feature width and every model starts from it."""
    docs = labelled_docs(spark, sf_dir).withColumn("label", F.col("label").cast("double"))
    tab = X.clean_text(docs, strategy="dictionary", keep=["label"])
    return M.materialize(random_split(tab, "doc_id", 0.8, SPLIT_SEED))


def text_features(spark, sf_dir, num_features: int = HASHED_FEATURES, clean=None):
    """(doc_id, label, split, features): hashed TF (V1) weighted by an IDF fitted on
    all rows (V2), as the reference. Checkpointed, because several estimators read it."""
    clean = clean if clean is not None else clean_labelled_tokens(spark, sf_dir)
    feats = V.hashed_tfidf(clean, "clean_tokens", num_features)
    return M.materialize(feats.select("doc_id", "label", "split", "features"))


def labelled_terms(spark, sf_dir):
    """(docs, terms): (doc_id, label, split) and (doc_id, label, split, term, n) of the
    T1-T3 tokens of the labelled text, checkpointed."""
    docs = labelled_docs(spark, sf_dir)
    toks = docs.select("doc_id", "label", X.letter_tokens("text").alias("tokens"))
    toks = M.materialize(random_split(toks, "doc_id", 0.8, SPLIT_SEED))
    terms = V.term_counts(toks, ["doc_id", "label", "split"]).withColumnRenamed("tf", "n")
    return toks.select("doc_id", "label", "split"), M.materialize(terms)


def tfidf_terms(docs, terms):
    """The counts weighted by ``ln((m + 1) / (df + 1))`` over all rows (V2)."""
    m = docs.count()
    df = M.materialize(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    d = V.join_term_stats(terms, df)
    return M.materialize(d.withColumn("n", F.col("n") * F.log((F.lit(m) + 1.0) / (F.col("df") + 1.0))).drop("df"))


_NB_SQL = """
WITH docs AS (SELECT min(d.doc_id) AS doc_id, d.text, l.quality AS label
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.text, l.quality),
ds AS (SELECT doc_id, label,
              CASE WHEN substr(md5('{seed}:' || CAST(doc_id AS VARCHAR)), 1, 4) < '{thr}'
                   THEN 'train' ELSE 'test' END AS split,
              {tokens} AS tokens FROM docs),
raw AS (SELECT doc_id, label, split, term, count(*) AS n
        FROM (SELECT doc_id, label, split, unnest(tokens) AS term FROM ds) u GROUP BY ALL),
tc AS (SELECT doc_id, label, split, term, {weight} AS n FROM raw),
v AS (SELECT count(DISTINCT term) AS nv FROM tc),
ntrain AS (SELECT count(*) AS n FROM ds WHERE split = 'train'),
cls AS (SELECT label AS c, count(*) AS nd FROM ds WHERE split = 'train' GROUP BY label),
nl AS (SELECT count(*) AS nl FROM cls),
prior AS (SELECT c, nd, ln(nd + 1.0) - ln(ntrain.n + nl.nl * 1.0) AS pi FROM cls, ntrain, nl),
ct AS (SELECT label AS c, term, sum(n) AS n, count(*) AS df FROM tc WHERE split = 'train'
       GROUP BY label, term),
ctot AS (SELECT c, coalesce(sum(ct.n), 0) AS tot FROM cls LEFT JOIN ct USING (c) GROUP BY c),
test_terms AS (SELECT tc.doc_id, tc.term, tc.n FROM tc WHERE split = 'test'),
test_docs AS (SELECT doc_id, label FROM ds WHERE split = 'test'),
"""

NB_MULTINOMIAL_SQL = _NB_SQL + """
scores AS (
  SELECT t.doc_id, t.label, p.c,
         p.pi + coalesce((SELECT sum(tt.n * (ln(coalesce(ct.n, 0) + 1.0) - ln(ctot.tot + v.nv)))
                          FROM test_terms tt LEFT JOIN ct ON ct.c = p.c AND ct.term = tt.term
                          WHERE tt.doc_id = t.doc_id), 0) AS s
  FROM test_docs t, prior p, ctot, v WHERE ctot.c = p.c)
SELECT {columns}
FROM scores GROUP BY doc_id, label"""

NB_BERNOULLI_SQL = _NB_SQL + """
theta AS (SELECT ct.c, ct.term, ln((ct.df + 1.0) / (p.nd + 2.0)) AS lt,
                 ln(1.0 - (ct.df + 1.0) / (p.nd + 2.0)) AS lnt
          FROM ct JOIN prior p ON ct.c = p.c),
negsum AS (SELECT p.c, coalesce(sum(th.lnt), 0)
                       + (v.nv - count(th.term)) * ln(1.0 - 1.0 / (p.nd + 2.0)) AS ns
           FROM prior p LEFT JOIN theta th ON th.c = p.c, v GROUP BY p.c, p.nd, v.nv),
scores AS (
  SELECT t.doc_id, t.label, p.c,
         p.pi + ns.ns + coalesce((SELECT sum(coalesce(th.lt, ln(1.0 / (p.nd + 2.0)))
                                          - coalesce(th.lnt, ln(1.0 - 1.0 / (p.nd + 2.0))))
                                  FROM test_terms tt LEFT JOIN theta th ON th.c = p.c AND th.term = tt.term
                                  WHERE tt.doc_id = t.doc_id), 0) AS s
  FROM test_docs t, prior p, negsum ns WHERE ns.c = p.c)
SELECT {columns}
FROM scores GROUP BY doc_id, label"""


_S1, _S0 = "max(s) FILTER (WHERE c = 1)", "max(s) FILTER (WHERE c = 0)"
_PREDICTION = f"doc_id, label, CASE WHEN {_S1} > {_S0} THEN 1 ELSE 0 END AS prediction"
_POSTERIOR = f"1.0 / (1.0 + exp({_S0} - ({_S1})))"
_IDF = ("n * ln(((SELECT count(*) FROM ds) + 1.0) / "
        "((SELECT count(*) FROM raw r WHERE r.term = raw.term) + 1.0))")


def nb_sql(template: str, columns: str, weight: str = "n") -> str:
    return template.format(seed=SPLIT_SEED, thr=split_threshold(0.8), tokens=TOKENS_SQL,
                           columns=columns, weight=weight)


def _split(feats):
    return (feats.where(F.col("split") == "train"), feats.where(F.col("split") == "test"))


def _text_model(spark, sf_dir, name, num_features):
    train, test = _split(text_features(spark, sf_dir, num_features))
    return M.fit_predict(name, train, test, ["doc_id"], seed=TREE_SEED)


@register("logistic_regression")
def logistic_regression(spark, sf_dir):
    """K1: test predictions of logistic regression on TF-IDF."""
    return _text_model(spark, sf_dir, "lr", HASHED_FEATURES)


@register("naive_bayes_multinomial", nb_sql(NB_MULTINOMIAL_SQL, _PREDICTION + f", round({_POSTERIOR}, 6) AS score",
                                            _IDF))
def naive_bayes_multinomial(spark, sf_dir):
    """K2: multinomial naive Bayes on TF-IDF weights over the exact vocabulary."""
    docs, terms = labelled_terms(spark, sf_dir)
    return NB.naive_bayes_scores(tfidf_terms(docs, terms), docs).withColumn("score", F.round("score", 6))


@register("naive_bayes_bernoulli")
def naive_bayes_bernoulli(spark, sf_dir):
    """K3: term presence, Bernoulli naive Bayes (the pandas half's model)."""
    return _text_model(spark, sf_dir, "nb_bernoulli", HASHED_FEATURES)


@register("naive_bayes_counts", nb_sql(NB_MULTINOMIAL_SQL, _PREDICTION))
def naive_bayes_counts(spark, sf_dir):
    """K2 on raw counts: multinomial naive Bayes (smoothing 1) over the exact
    vocabulary; its closed form is the SQL twin."""
    docs, terms = labelled_terms(spark, sf_dir)
    return NB.naive_bayes_scores(terms, docs).drop("score")


@register("naive_bayes_presence", nb_sql(NB_BERNOULLI_SQL, _PREDICTION))
def naive_bayes_presence(spark, sf_dir):
    """K3 on term presence: Bernoulli naive Bayes over the exact vocabulary."""
    docs, terms = labelled_terms(spark, sf_dir)
    return NB.naive_bayes_scores(terms, docs, "bernoulli").drop("score")


def hashed_rows(feats):
    """(key, label, train, features) for the trees: the hashed TF-IDF (V1, V2) of
    ``text_features`` as an array of (f, v), all 2^18 features, checkpointed."""
    return M.materialize(feats.select(
        F.col("doc_id").alias("key"), F.col("label").cast("int").alias("label"), (F.col("split") == "train").alias("train"),
        V.vector_entries("features", "f", "v", TR.FEATURES).alias("features")))


def tree_predictions(name, rows, **options):
    """(model, doc_id, label, prediction, score) of the test rows."""
    found = TR.tree_scores(TR.grow(rows, TREE_DEPTH, seed=TREE_SEED, **options), rows)
    return rows.where(~F.col("train")).select("key", "label").join(found, "key") \
               .select(F.lit(name).alias("model"), F.col("key").alias("doc_id"), "label", "prediction", "score")


FOREST = dict(trees=FOREST_TREES, bootstrap=True, subset=FOREST_SUBSET)


@register("decision_tree")
def decision_tree(spark, sf_dir):
    """K4: exact depth-5 tree on all 2^18 hashed features."""
    return tree_predictions("dt", hashed_rows(text_features(spark, sf_dir)))


@register("random_forest")
def random_forest(spark, sf_dir):
    """K5: 20 exact trees of depth 5 on all 2^18 hashed features, seeded."""
    return tree_predictions("rf", hashed_rows(text_features(spark, sf_dir)), **FOREST)


@register("predict_proba", nb_sql(NB_BERNOULLI_SQL, f"doc_id, round({_POSTERIOR}, 6) AS score"))
def predict_proba(spark, sf_dir):
    """Positive-class probability of every test row (Bernoulli naive Bayes)."""
    docs, terms = labelled_terms(spark, sf_dir)
    return NB.naive_bayes_scores(terms, docs, "bernoulli").select("doc_id", F.round("score", 6).alias("score"))


@register("vector_element", nb_sql(NB_MULTINOMIAL_SQL, f"doc_id, round({_POSTERIOR}, 6) AS p_positive"))
def vector_element(spark, sf_dir):
    """Element 1 of the probability vector (p0, p1) of every test row."""
    docs, terms = labelled_terms(spark, sf_dir)
    p = F.array(F.lit(1.0) - F.col("score"), F.col("score"))
    return NB.naive_bayes_scores(terms, docs).select("doc_id", F.round(F.element_at(p, 2), 6).alias("p_positive"))


def tabular_table(spark, sf_dir):
    """(doc_id, n_chars, n_tokens, n_distinct_tokens, quality): label last."""
    d = T.labelled_text(spark, sf_dir)
    toks = X.letter_tokens("text")
    return d.select("doc_id", "n_chars", F.size(toks).alias("n_tokens"),
                    F.size(F.array_distinct(toks)).alias("n_distinct_tokens"), "quality")


DEPTHS = (1, 5, 32)


def overfit_predictions(spark, sf_dir):
    """Stacked train and test predictions of trees of depth 1, 5 and 32 (K6): one exact tree,
    cut at each depth."""
    from kestrel.operators.relational import positional_features
    tab = positional_features(tabular_table(spark, sf_dir), keep=["doc_id"])
    tab = exact_split(tab, "doc_id", 0.2, 42)
    rows = M.materialize(tab.select(
        F.col("doc_id").alias("key"), F.col("label").cast("int").alias("label"),
        (F.col("split") == "train").alias("train"), TR.sparse("features").alias("features"), "split"))
    leaves = M.materialize(TR.grow(rows, max(DEPTHS)))
    out = None
    for depth in DEPTHS:
        p = TR.tree_scores(leaves, rows, depth).join(rows.select("key", "label", "split"), "key") \
              .select(F.lit(f"depth_{depth}").alias("model"), F.col("key").alias("doc_id"), "split",
                      "label", "prediction", "score")
        out = p if out is None else out.unionByName(p)
    return out


# The tree in SQL: every step reads the rows of the open nodes, finds each node's best
# threshold over all values of all features, and sends the rows of split nodes on.
_TREE_SQL = """
WITH RECURSIVE base AS (
  SELECT d.doc_id, l.quality AS y, [d.n_chars, len(t.tokens), len(list_distinct(t.tokens))]::DOUBLE[] AS x,
         row_number() OVER (ORDER BY md5('42:' || CAST(d.doc_id AS VARCHAR)), CAST(d.doc_id AS VARCHAR))
         > ceil(count(*) OVER () * 0.2) AS train
  FROM documents d JOIN labels l USING (doc_id) JOIN {tokens} t USING (doc_id)),
tree AS (
  SELECT 0 AS depth, 1::BIGINT AS node, doc_id, y, x, train FROM base
  UNION ALL (
  WITH tot AS (SELECT node, sum(1 - y)::DOUBLE AS n0, sum(y)::DOUBLE AS n1 FROM tree WHERE train GROUP BY node),
  val AS (SELECT node, f, x[f] AS v, sum(1 - y)::DOUBLE AS s0, sum(y)::DOUBLE AS s1
          FROM tree, range(1, 4) r(f) WHERE train GROUP BY node, f, x[f]),
  cum AS (SELECT node, f, v, sum(s0) OVER w AS l0, sum(s1) OVER w AS l1, lead(v) OVER w AS nxt FROM val
          WINDOW w AS (PARTITION BY node, f ORDER BY v)),
  gain AS (SELECT node, f, (v + nxt) / 2 AS cut, n0, n1,
                  (l0 * l0 + l1 * l1) / (l0 + l1) + ((n0 - l0) * (n0 - l0) + (n1 - l1) * (n1 - l1)) / ((n0 - l0) + (n1 - l1)) AS g
           FROM cum JOIN tot USING (node) WHERE nxt IS NOT NULL AND n0 > 0 AND n1 > 0),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY g DESC, f, cut) AS r FROM gain)
           WHERE r = 1 AND g > (n0 * n0 + n1 * n1) / (n0 + n1) * (1 + 1e-9))
  SELECT depth + 1, 2 * node + (x[f] > cut)::BIGINT, doc_id, y, x, train FROM tree JOIN best USING (node) WHERE depth < 32)),
shares AS (SELECT node, (sum(y) FILTER (WHERE train))::DOUBLE / count(*) FILTER (WHERE train) AS p FROM tree GROUP BY node),
leaf AS (SELECT m.depth AS cut, t.doc_id, t.y, t.train, max(t.node) AS node
         FROM tree t JOIN (VALUES (1), (5), (32)) m(depth) ON t.depth <= m.depth GROUP BY ALL),
acc AS (SELECT 'depth_' || cut AS model, CASE WHEN train THEN 'train' ELSE 'test' END AS split,
               avg(CASE WHEN (coalesce(p, 0) > 0.5)::INT = y THEN 1.0 ELSE 0.0 END) AS accuracy
        FROM leaf JOIN shares USING (node) GROUP BY ALL)
"""
TREE_SQL = _TREE_SQL.format(tokens=f"(SELECT doc_id, {TOKENS_SQL} AS tokens FROM documents)")


@register("depth_sweep", TREE_SQL + "SELECT model, split, accuracy FROM acc")
def depth_sweep(spark, sf_dir):
    """K6 + E13: train and test accuracy of trees of depth 1, 5 and 32."""
    return E.classification_metrics(overfit_predictions(spark, sf_dir), ["model", "split"]) \
            .select("model", "split", "accuracy")


@register("kmeans_assign")
def kmeans_assign(spark, sf_dir):
    """K8: k-means with k = 4, seed 13, on the 64-dimensional embeddings."""
    _, assigned = M.kmeans_fit(T.load(spark, sf_dir, "embeddings"), KMEANS_K, KMEANS_SEED)
    return assigned.select("vec_id", "cluster")


@register("kmeans_centers", """
SELECT label, CAST(i - 1 AS INTEGER) AS dim, avg(CAST(embedding[i] AS DOUBLE)) AS mean
FROM embeddings, range(1, 65) r(i) GROUP BY label, i""")
def kmeans_centers(spark, sf_dir):
    """K9, mean form: the centre of every given label, per dimension."""
    return M.group_means(T.load(spark, sf_dir, "embeddings"), "label")


@register("kmeans_model_centers")
def kmeans_model_centers(spark, sf_dir):
    """K9: the fitted k-means centres as (cluster, dim, center) rows."""
    model, _ = M.kmeans_fit(T.load(spark, sf_dir, "embeddings"), KMEANS_K, KMEANS_SEED)
    return M.kmeans_centers(model, spark)


@register("silhouette", """
WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pair AS (SELECT a.vec_id, a.label AS la, b.label AS lb, list_sum(list_transform(list_zip(a.x, b.x),
                 lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS d
         FROM p a JOIN p b ON a.vec_id <> b.vec_id),
per AS (SELECT vec_id, la, lb, avg(d) AS md FROM pair GROUP BY vec_id, la, lb),
ab AS (SELECT vec_id, max(CASE WHEN la = lb THEN md END) AS a, min(CASE WHEN la <> lb THEN md END) AS b
       FROM per GROUP BY vec_id)
SELECT avg(CASE WHEN a IS NULL THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END)
       AS silhouette FROM ab""")
def silhouette(spark, sf_dir):
    """Silhouette of the given labels, squared Euclidean distance."""
    return M.mean_silhouette(T.load(spark, sf_dir, "embeddings"), "label")
