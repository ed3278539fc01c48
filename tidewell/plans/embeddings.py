"""Word vectors and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import numeric as nm
from tidewell.functions.hashing import mix_sql, uniform_sql
from tidewell.functions.text import sentences, words
from tidewell.operators import cooccur as co
from tidewell.operators import terms
from tidewell.operators import vectors as ve
from tidewell.operators import wordvec as wv
from tidewell.plans.base import query, table
from tidewell.plans.standins import WORDS_SQL, plain_texts

_SENT_SQL = r"""list_filter(string_split(regexp_replace(text, '([.!?])[\t\n\x0B\f\r ]+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '')"""
_POS = f"pos AS (SELECT doc_id, unnest(t) AS token, unnest(range(0, len(t))) AS p FROM (SELECT doc_id, {WORDS_SQL} AS t FROM documents) WHERE len(t) > 0)"
_KEPT = f"{_POS}, kept AS (SELECT token FROM pos GROUP BY token HAVING count(*) > 5)"


def _positions(spark, d):
    return plain_texts(spark, d).select("doc_id", F.posexplode(words(F.col("text"))).alias("p", "token"))


@query("e1_frequent_tokens", f"WITH {_KEPT} SELECT doc_id, p, token FROM pos WHERE token IN (SELECT token FROM kept)")
def e1(spark, d):
    return wv.frequent_tokens(_positions(spark, d), 5).select("doc_id", F.col("p").cast("long").alias("p"), "token")


_IDS = f"""{_KEPT}, v AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM kept),
ids AS (SELECT doc_id, p, pos.token, coalesce(idx, (SELECT count(*) FROM v)) AS id FROM pos LEFT JOIN v ON pos.token = v.token)"""


def _token_counts(spark, d):
    """(token, n) of all words, written once: a word is one row for all its places."""
    from tidewell.session import rewrite

    return rewrite(_positions(spark, d).groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token-counts")[0]


def _vocabulary(spark, d):
    """(token, idx) of the frequent words, and (token, n) of all words."""
    from tidewell.session import cut_lineage

    counted = _token_counts(spark, d)
    return cut_lineage(terms.vocabulary(wv.frequent_tokens(counted, 5, times="n"), unknown=True)), counted


def _ids(spark, d):
    vocab, _ = _vocabulary(spark, d)
    return wv.token_ids(_positions(spark, d), vocab), vocab


@query("e2_token_ids", f"WITH {_IDS} SELECT doc_id, p, id FROM ids")
def e2(spark, d):
    return _ids(spark, d)[0].select("doc_id", F.col("p").cast("long").alias("p"), "id")


@query("j4_lookup_default", f"WITH {_IDS} SELECT id, count(*) AS n FROM ids GROUP BY id")
def j4(spark, d):
    return _ids(spark, d)[0].groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("f18_invert_map", f"WITH {_IDS} SELECT idx AS id, token, CASE WHEN idx % 3 = 0 THEN '<unk>' ELSE token END AS again FROM v UNION ALL SELECT count(*), '<unk>', '<unk>' FROM v")
def f18(spark, d):
    """id to token: swapped columns, then a look-up in maps that lack every third id."""
    _, vocab = _ids(spark, d)
    inverse = vocab.select(F.col("idx").alias("id"), "token")
    other = F.when(F.col("id") % 3 == 0, F.col("id") + 1).otherwise(F.col("id"))
    m = F.create_map(other, F.col("token"))
    return inverse.select("id", "token", nm.map_get(m, F.col("id"), F.lit("<unk>")).alias("again"))


_SG_SQL = f"""sg AS (SELECT c.token AS center, o.token AS context FROM pos c JOIN (SELECT *, p - k AS q FROM pos CROSS JOIN (SELECT unnest([-2, -1, 1, 2]) AS k)) o
 ON c.doc_id = o.doc_id AND c.p = o.q JOIN (SELECT doc_id, max(p) + 1 AS n FROM pos GROUP BY doc_id) l ON l.doc_id = c.doc_id WHERE c.p >= 2 AND c.p < l.n - 2)"""


def _sg(spark, d):
    t = plain_texts(spark, d).select(words(F.col("text")).alias("t"))
    return co.skipgram_counts(t, "t", 2)


@query("e4_skipgram_pairs", f"WITH {_POS}, {_SG_SQL} SELECT center, context, count(*) AS n FROM sg GROUP BY ALL")
def e4(spark, d):
    return _sg(spark, d)


@query(
    "e4_sentence_pairs",
    f"""WITH {_IDS}, se AS (SELECT doc_id, unnest(s) AS t, unnest(range(0, len(s))) AS s FROM (SELECT doc_id, {_SENT_SQL} AS s FROM documents) WHERE len(s) > 0),
        sw AS (SELECT doc_id, s, unnest(w) AS token, unnest(range(0, len(w))) AS p, len(w) AS n FROM (SELECT doc_id, s, {WORDS_SQL.replace("text", "t")} AS w FROM se) WHERE len(w) > 0),
        si AS (SELECT doc_id, s, p, n, coalesce(idx, (SELECT count(*) FROM v)) AS id FROM sw LEFT JOIN v ON v.token = sw.token)
        SELECT c.id AS center, o.id AS context, count(*) AS n FROM si c JOIN (SELECT *, p - k AS q FROM si CROSS JOIN (SELECT unnest([-2, -1, 1, 2]) AS k)) o
        ON c.doc_id = o.doc_id AND c.s = o.s AND c.p = o.q WHERE c.p >= 2 AND c.p < c.n - 2 GROUP BY ALL""",
)
def e4_sentences(spark, d):
    """Skip-gram pairs of ids within sentences, rare words as the unknown id."""
    _, vocab = _ids(spark, d)
    s = plain_texts(spark, d).select("doc_id", F.posexplode(sentences(F.col("text"))).alias("s", "t"))
    tokens = s.select("doc_id", "s", words(F.col("t")).alias("tokens"))
    ids = wv.sentence_ids(tokens, vocab, ["doc_id", "s"])
    return co.skipgram_counts(ids, "ids", 2)


_NOISE = f"""{_IDS}, cnt AS (SELECT id, count(*) AS n FROM ids WHERE id < (SELECT count(*) FROM v) GROUP BY id),
noise AS (SELECT id, pow(n::DOUBLE, 0.75::DOUBLE) / (SELECT sum(pow(n::DOUBLE, 0.75::DOUBLE)) FROM cnt) AS p FROM cnt)"""


def _id_counts(spark, d):
    return _counts_of_ids(*_vocabulary(spark, d))


def _counts_of_ids(vocab, counted):
    """(id, n) of the frequent words."""
    from tidewell.session import cut_lineage

    unknown = vocab.where("token = '<unk>'").select("idx").scalar()
    return cut_lineage(wv.token_ids(counted, vocab).groupBy("id").agg(F.sum("n").alias("n")).where(F.col("id") < unknown))


@query("e5_noise_distribution", f"WITH {_NOISE} SELECT id, round(p, 9) AS p FROM noise")
def e5(spark, d):
    return wv.noise_distribution(_id_counts(spark, d)).select("id", F.round("p", 9).alias("p"))


# vectors of the given table serve as word vectors below
def _vecs(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


_VEC_PAIRS = "vp AS (SELECT a.vec_id AS center, b.vec_id AS context FROM embeddings a JOIN embeddings b ON b.vec_id = (a.vec_id * 7 + 3) % (SELECT count(*) FROM embeddings))"
_VEC_NOISE = """vcnt AS (SELECT vec_id AS id, label + 1 AS n FROM embeddings),
vn AS (SELECT id, greatest(CAST(floor(pow(n::DOUBLE, 0.75::DOUBLE) / (SELECT sum(pow(n::DOUBLE, 0.75::DOUBLE)) FROM vcnt) * 1000000000) AS BIGINT), 1) AS k FROM vcnt),
slices AS (SELECT id, CAST(sum(k) OVER (ORDER BY id) - k AS BIGINT) AS lo, CAST(sum(k) OVER (ORDER BY id) AS BIGINT) AS hi FROM vn)"""
_VEC_DRAWS = f"""{_VEC_PAIRS}, {_VEC_NOISE},
draws AS (SELECT center, context, draw, {mix_sql('center', 'context', 'draw', seed=42)} % (SELECT max(hi) FROM slices) AS tick FROM vp CROSS JOIN (SELECT unnest(range(0, 15)) AS draw)),
nz AS (SELECT center, context, draw, id AS noise FROM draws JOIN slices ON lo <= tick AND tick < hi)"""


def _vec_pairs(spark, d):
    v = _vecs(spark, d)
    n = v.agg(F.count(F.lit(1)).alias("n")).scalar()
    return v.select(F.col("id").alias("center"), ((F.col("id") * 7 + 3) % n).alias("context"))


def _vec_noise(spark, d):
    counts = _vecs(spark, d).select("id", (F.col("label") + 1).alias("n"))
    return wv.sample_noise(_vec_pairs(spark, d), wv.noise_distribution(counts))


@query("e6_negative_samples", f"WITH {_VEC_DRAWS} SELECT center, context, CAST(draw AS INTEGER) AS draw, noise FROM nz")
def e6(spark, d):
    return _vec_noise(spark, d)


_DOT = "CAST(list_sum(list_transform(list_zip(x.embedding, y.embedding), lambda q: q[1]::DOUBLE * q[2]::DOUBLE)) AS DOUBLE)"


@query(
    "e7_sgns_loss",
    f"""WITH {_VEC_DRAWS}, s AS (
          SELECT -1 AS draw, 1.0::DOUBLE AS y, {_DOT} AS z FROM vp JOIN embeddings x ON x.vec_id = center JOIN embeddings y ON y.vec_id = context
          UNION ALL SELECT draw, 0.0::DOUBLE, {_DOT} FROM nz JOIN embeddings x ON x.vec_id = center JOIN embeddings y ON y.vec_id = noise),
        m AS (SELECT draw, avg(greatest(z, 0) - z * y + ln(1 + exp(-abs(z)))) AS m FROM s GROUP BY draw)
        SELECT round(sum(CASE WHEN draw < 0 THEN m END), 6) AS positive, round(sum(CASE WHEN draw >= 0 THEN m END), 6) AS negative, round(sum(m), 6) AS loss FROM m""",
)
def e7(spark, d):
    loss = wv.sgns_loss(_vec_pairs(spark, d), _vec_noise(spark, d), _vecs(spark, d).select("id", "vec"))
    return loss.select(*[F.round(c, 6).alias(c) for c in loss.columns])


@query("e8_train_sgns")
def e8(spark, d):
    """Norms of the vectors of all frequent words."""
    vocab, counted = _vocabulary(spark, d)
    counts = _counts_of_ids(vocab, counted)
    unknown = vocab.where("token = '<unk>'").select("idx").scalar()
    ids = wv.token_ids(_positions(spark, d), vocab).where(F.col("id") < unknown)
    pairs = co.skipgram_pairs(wv.sequences(ids, "doc_id"), "ids", 2)
    vecs = wv.train_sgns(pairs, counts, dim=16, epochs=3, rate=0.01, negatives=5).vectors
    return vecs.select("id", F.size("vec").alias("dim"), F.round(nm.l2_norm(F.col("vec")), 4).alias("norm"))


@query(
    "e10_matrix_triples",
    f"WITH {_KEPT}, f AS (SELECT a.token AS a, b.token AS b, 1.0::DOUBLE / k AS w FROM pos a JOIN (SELECT *, p - k AS q FROM pos CROSS JOIN (SELECT unnest(range(1, 4)) AS k)) b ON a.doc_id = b.doc_id AND a.p = b.q), "
    "s AS (SELECT a, b, w FROM f UNION ALL SELECT b, a, w FROM f) SELECT a, b, round(sum(w), 6) AS x FROM s WHERE a IN (SELECT token FROM kept) AND b IN (SELECT token FROM kept) GROUP BY a, b",
)
def e10(spark, d):
    """Non-zero entries between vocabulary words; positions of other words still count as distance."""
    t = plain_texts(spark, d).select(words(F.col("text")).alias("t"))
    kept = wv.frequent_tokens(_token_counts(spark, d), 5, times="n").select("token").distinct()
    pairs = co.cooccurrence(wv.look_up(t, "t", kept.withColumn("own", F.col("token")), "own"), "t", 3, distance_weight=True, skip_null=True)
    return pairs.select("a", "b", F.round("n", 6).alias("x"))


_U = lambda a, j, s: uniform_sql(a, j, seed=s)


@query(
    "e11_glove_loss",
    f"""WITH tri AS (SELECT o_custkey AS i, o_custkey // 3 AS j, count(*)::DOUBLE * 9 AS x FROM orders GROUP BY ALL),
        e AS (SELECT x, (SELECT sum(({_U('i', 'k', 7)} - 0.5::DOUBLE) * ({_U('j', 'k', 8)} - 0.5::DOUBLE)) FROM (SELECT unnest(range(0, 4)) AS k))
                + {_U('i', '999', 7)} - 0.5::DOUBLE + {_U('j', '999', 8)} - 0.5::DOUBLE - ln(x) AS err FROM tri)
        SELECT round(sum(CASE WHEN x < 100 THEN pow(x / 100.0::DOUBLE, 0.75::DOUBLE) ELSE 1.0::DOUBLE END * err * err), 4) AS loss FROM e""",
)
def e11(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("i"), F.floor(F.col("o_custkey") / 3).alias("j"))
    tri = o.groupBy("i", "j").agg((F.count(F.lit(1)).cast("double") * 9).alias("x"))
    left = wv.hashed_vectors(tri.select(F.col("i").alias("id")).distinct(), 4, 7)
    right = wv.hashed_vectors(tri.select(F.col("j").alias("id")).distinct(), 4, 8)
    return wv.glove_loss(tri, left, right).select(F.round("loss", 4).alias("loss"))


@query("e12_train_glove")
def e12(spark, d):
    from tidewell.session import cut_lineage

    t = plain_texts(spark, d).select(words(F.col("text")).alias("t"))
    kept = wv.frequent_tokens(_token_counts(spark, d), 5, times="n")
    vocab = cut_lineage(terms.vocabulary(kept))
    # words are numbered where they are, so pairs are counted as ids and need no join
    p = co.cooccurrence(wv.look_up(t, "t", vocab, "idx"), "t", 5, distance_weight=True, skip_null=True)
    tri = p.select(F.col("a").alias("i"), F.col("b").alias("j"), F.col("n").alias("x"))
    v = wv.train_glove(tri, dim=8, rounds=2)
    return v.select("id", F.size("vec").alias("dim"), F.round(nm.l2_norm(F.col("vec")), 3).alias("norm"))


_COS = f"({_DOT} / (sqrt(list_sum(list_transform(x.embedding, lambda q: q::DOUBLE * q::DOUBLE))) * sqrt(list_sum(list_transform(y.embedding, lambda q: q::DOUBLE * q::DOUBLE)))))"


@query(
    "e13_nearest",
    f"""WITH s AS (SELECT x.vec_id AS query, y.vec_id AS neighbour, {_COS} AS similarity FROM embeddings x CROSS JOIN embeddings y WHERE x.vec_id < 20),
        r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, neighbour) AS rank FROM s)
        SELECT query, neighbour, round(similarity, 6) AS similarity, CAST(rank - 1 AS INTEGER) AS rank FROM r WHERE rank BETWEEN 2 AND 4""",
)
def e13(spark, d):
    """Neighbours of twenty query words among all vectors; the list of queries is the operator's input."""
    v = _vecs(spark, d).select("id", "vec")
    n = ve.cosine_neighbours(v, v.where("id < 20"), 3, 64)
    return n.select("query", "neighbour", F.round("similarity", 6).alias("similarity"), "rank")


@query(
    "j9_query_against_all",
    f"SELECT y.vec_id AS id, round({_COS}, 6) AS similarity FROM embeddings x CROSS JOIN embeddings y WHERE x.vec_id = 5",
)
def j9(spark, d):
    """One query vector, as a scalar, against every vector: a scan without a join."""
    v = _vecs(spark, d)
    q = v.where("id = 5").select("vec").scalar()
    scored = v.withColumn("_q", q).select("id", nm.cosine(F.col("_q"), F.col("vec")).alias("s"))
    return scored.select("id", F.round("s", 6).alias("similarity"))


_GRAPH_SQL = f"""s AS (SELECT x.vec_id AS query, y.vec_id AS neighbour, {_COS} AS similarity FROM embeddings x CROSS JOIN embeddings y),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, neighbour) - 1 AS rank FROM s)"""


@query("e14_neighbour_graph", f"WITH {_GRAPH_SQL} SELECT query, neighbour, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM r WHERE rank BETWEEN 1 AND 10")
def e14(spark, d):
    g = ve.neighbour_graph(_vecs(spark, d).select("id", "vec"), 10, 64)
    return g.select("query", "neighbour", F.round("similarity", 6).alias("similarity"), "rank")


@query("e15_fuzzy_graph")
def e15(spark, d):
    g = ve.neighbour_graph(_vecs(spark, d).select("id", "vec"), 10, 64)
    from tidewell.session import cut_lineage

    w = ve.fuzzy_union(cut_lineage(ve.fuzzy_weights(g)))
    return w.select("src", "dst", F.round("weight", 6).alias("weight"))


@query("e15_weight_sums", "SELECT vec_id AS src, round(log2(10.0::DOUBLE), 6) AS total FROM embeddings")
def e15_sums(spark, d):
    """What defines the widths: the weights of every vector's neighbours add up to log2(k)."""
    g = ve.neighbour_graph(_vecs(spark, d).select("id", "vec"), 10, 64)
    return ve.fuzzy_weights(g).groupBy("src").agg(F.round(F.sum("weight"), 6).alias("total"))


@query(
    "e15_fuzzy_union",
    f"""WITH w AS (SELECT l_suppkey AS src, l_partkey % 100 AS dst, {uniform_sql('l_suppkey', 'l_partkey % 100', seed=9)} AS w FROM lineitem GROUP BY ALL)
        SELECT coalesce(a.src, b.dst) AS src, coalesce(a.dst, b.src) AS dst,
        round(coalesce(a.w, 0) + coalesce(b.w, 0) - coalesce(a.w, 0) * coalesce(b.w, 0), 6) AS weight FROM w a FULL JOIN w b ON a.src = b.dst AND a.dst = b.src""",
)
def e15_union(spark, d):
    from tidewell.functions.hashing import uniform

    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 100).alias("dst")).distinct()
    u = ve.fuzzy_union(li.withColumn("weight", uniform(F.col("src"), F.col("dst"), seed=9)))
    return u.select("src", "dst", F.round("weight", 6).alias("weight"))


def _pca(spark, d):
    """Vectors with their three scores ``p``, and the loadings; signs are fixed by the largest loading."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = _vecs(spark, d).select("id", F.transform("vec", lambda x: x.cast("double")).alias("x"))
    v = v.withColumn("f", array_to_vector("x"))
    model = PCA(k=3, inputCol="f", outputCol="pc").fit(v)
    loadings = model.pc.toArray()
    loadings = loadings * [1.0 if loadings[abs(loadings[:, j]).argmax(), j] > 0 else -1.0 for j in range(3)]
    sign = [1.0 if abs(model.pc.toArray()[:, j] - loadings[:, j]).max() == 0 else -1.0 for j in range(3)]
    pc = model.transform(v).select("id", "x", vector_to_array("pc").alias("p"))
    return pc.select("id", "x", F.array(*[F.col("p")[j] * sign[j] for j in range(3)]).alias("p")), loadings


@query("e16_pca")
def e16(spark, d):
    """Three principal components; signs are fixed by the largest loading."""
    pc, _ = _pca(spark, d)
    return pc.select("id", *[F.round(F.col("p")[j], 6).alias(f"pc_{j + 1}") for j in range(3)])


@query(
    "e16_eigen_identity",
    "SELECT d.i::INTEGER AS dimension, k.j::INTEGER AS component, 0.0::DOUBLE AS difference FROM (SELECT unnest(range(64)) AS i) d, (SELECT unnest(range(1, 4)) AS j) k",
)
def e16_identity(spark, d):
    """What defines a component: a dimension's covariance with the score is the score's variance times the loading."""
    pc, loadings = _pca(spark, d)
    flat = pc.select("p", F.posexplode("x").alias("dimension", "x"))
    found = flat.groupBy("dimension").agg(
        F.array(*[F.struct(F.covar_samp("x", F.col("p")[j]).alias("c"), F.var_samp(F.col("p")[j]).alias("v")) for j in range(3)]).alias("e")
    )
    # as many loadings as a vector has dimensions
    own = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(loadings)], "dimension int, w array<double>")
    rows = found.join(own, "dimension").select("dimension", F.posexplode(F.arrays_zip("e", "w")).alias("j", "z"))
    off = F.col("z.e.c") - F.col("z.e.v") * F.col("z.w")
    return rows.select("dimension", (F.col("j") + 1).alias("component"), (F.round(off, 6) + F.lit(0.0)).alias("difference"))


@query(
    "e17_analogy",
    """WITH t AS (SELECT unnest(range(1, 65)) AS i), q AS (SELECT i, sum(CASE vec_id WHEN 7 THEN -embedding[i]::DOUBLE ELSE embedding[i]::DOUBLE END) AS v FROM embeddings, t WHERE vec_id IN (5, 7, 9) GROUP BY i),
       s AS (SELECT vec_id AS neighbour, sum(embedding[i]::DOUBLE * v) / (sqrt(sum(v * v)) * sqrt(sum(embedding[i]::DOUBLE * embedding[i]::DOUBLE))) AS similarity FROM embeddings, q WHERE vec_id NOT IN (5, 7, 9) GROUP BY vec_id)
       SELECT neighbour, round(similarity, 6) AS similarity, CAST(row_number() OVER (ORDER BY similarity DESC, neighbour) AS INTEGER) AS rank FROM s ORDER BY similarity DESC, neighbour LIMIT 5""",
)
def e17(spark, d):
    a = ve.analogy(_vecs(spark, d).select("id", F.transform("vec", lambda x: x.cast("double")).alias("vec")), [5, 9], [7], 5, 64)
    return a.select("neighbour", F.round("similarity", 6).alias("similarity"), "rank")


@query(
    "f_vector_math",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda q: q::DOUBLE * q::DOUBLE))), 6) AS norm,
       CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS top,
       round(exp(embedding[1]::DOUBLE - list_max(embedding)::DOUBLE) / list_sum(list_transform(embedding, lambda q: exp(q::DOUBLE - list_max(embedding)::DOUBLE))), 6) AS p_first FROM embeddings""",
)
def f16(spark, d):
    v = _vecs(spark, d).select("id", "vec", F.transform("vec", lambda x: x.cast("double")).alias("w"))
    return v.select(
        F.col("id").alias("vec_id"), F.round(nm.l2_norm(F.col("w")), 6).alias("norm"), nm.argmax(F.col("vec")).alias("top"),
        F.round(F.element_at(nm.softmax(F.col("w")), 1), 6).alias("p_first"),
    )
