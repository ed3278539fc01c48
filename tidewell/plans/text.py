"""Text features and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import text as tx
from tidewell.functions.hashing import mix, mix_sql, normal, normal_sql
from tidewell.functions.numeric import log_softmax
from tidewell.operators import classify as cl
from tidewell.operators import cooccur as co
from tidewell.operators import terms
from tidewell.plans.base import query, table
from tidewell.session import spread
from tidewell.plans.standins import MARKS_SQL, SPACES_SQL, WORDS_SQL, articles, doc_words, plain_texts

_TOK = f"tok AS (SELECT doc_id, unnest({WORDS_SQL}) AS token FROM documents)"
_TF = f"{_TOK}, tf AS (SELECT doc_id, token, count(*) AS n FROM tok GROUP BY ALL), df AS (SELECT token, count(*) AS df FROM tf GROUP BY token)"


def _docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def _tokens(spark, d):
    return doc_words(_docs(spark, d))


@query(
    "x1_tokenise",
    f"SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, {WORDS_SQL} AS t FROM documents)",
)
def x1(spark, d):
    t = _docs(spark, d).select("doc_id", tx.words(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query(
    "f_words_and_marks",
    f"SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, {MARKS_SQL} AS t FROM documents)",
)
def f7(spark, d):
    t = _docs(spark, d).select("doc_id", tx.words_and_marks(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query(
    "f_split_spaces",
    f"SELECT doc_id, len(t) AS n_tokens, array_to_string(t, '|') AS tokens FROM (SELECT doc_id, {SPACES_SQL} AS t FROM documents)",
)
def f5(spark, d):
    t = _docs(spark, d).select("doc_id", tx.split_spaces(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", "|").alias("tokens"))


_SENT_SQL = r"""list_filter(string_split(regexp_replace(text, '([.!?])[\t\n\x0B\f\r ]+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '')"""


@query("e3_sentences", f"SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, array_to_string(s, '|') AS sentences FROM (SELECT doc_id, {_SENT_SQL} AS s FROM documents)")
def e3(spark, d):
    s = _docs(spark, d).select("doc_id", tx.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.array_join("s", "|").alias("sentences"))


@query("a2_word_counts", f"WITH {_TOK} SELECT token, count(*) AS n FROM tok GROUP BY token")
def a2(spark, d):
    return _tokens(spark, d).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("a3_distinct_sorted", "SELECT DISTINCT lang, source FROM documents ORDER BY lang, source")
def a3(spark, d):
    return table(spark, d, "documents").select("lang", "source").distinct().orderBy("lang", "source")


@query("a8_document_frequency", f"WITH {_TF} SELECT token, df FROM df")
def a8(spark, d):
    return terms.document_frequency(terms.term_counts(_tokens(spark, d)))


@query(
    "a9_frequency_floor",
    f"WITH {_TOK}, c AS (SELECT token, count(*) AS n FROM tok GROUP BY token) SELECT token, n, CAST(n > 20 AS INTEGER) AS above FROM c WHERE n >= 20",
)
def a9(spark, d):
    """Both comparisons in use: at least the floor, and strictly above it."""
    c = _tokens(spark, d).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return c.where(F.col("n") >= 20).select("token", "n", (F.col("n") > 20).cast("int").alias("above"))


@query("x2_vocabulary", f"WITH {_TOK}, v AS (SELECT DISTINCT token FROM tok) SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM v UNION ALL SELECT '<unk>', count(*) FROM v")
def x2(spark, d):
    return terms.vocabulary(_tokens(spark, d), unknown=True)


@query("x3_one_hot", f"WITH {_TOK}, v AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM (SELECT DISTINCT token FROM tok)) SELECT token AS word, idx, 1 AS value FROM v")
def x3(spark, d):
    return terms.one_hot(terms.vocabulary(_tokens(spark, d)))


@query("x4_log_tf", f"WITH {_TF} SELECT doc_id, token, n, round(1.0::DOUBLE + log10(n), 6) AS tf FROM tf")
def x4(spark, d):
    from tidewell.functions.numeric import log_tf

    return terms.term_counts(_tokens(spark, d)).select("doc_id", "token", "n", F.round(log_tf(F.col("n")), 6).alias("tf"))


@query("x5_idf", f"WITH {_TF} SELECT token, df, round(log10((SELECT count(*) FROM documents) / CAST(df AS DOUBLE)), 6) AS idf FROM df")
def x5(spark, d):
    from tidewell.functions.numeric import idf

    df = terms.document_frequency(terms.term_counts(_tokens(spark, d)))
    n = _docs(spark, d).agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.select("token", "df", F.round(idf(n, F.col("df")), 6).alias("idf"))


@query(
    "x6_tfidf",
    f"""WITH {_TF} SELECT doc_id, tf.token, round((1.0::DOUBLE + log10(n)) * log10((SELECT count(*) FROM documents) / CAST(df AS DOUBLE)), 6) AS tfidf
        FROM tf JOIN df ON tf.token = df.token""",
)
def x6(spark, d):
    return terms.tfidf(_tokens(spark, d), _docs(spark, d)).select("doc_id", "token", F.round("tfidf", 6).alias("tfidf"))


_TRANSFORM_SQL = f"""
WITH alltok AS (SELECT doc_id, doc_id % 5 = 0 AS held, unnest({WORDS_SQL}) AS token FROM documents),
train AS (SELECT doc_id, token, count(*) AS n FROM alltok WHERE NOT held GROUP BY ALL),
tdf AS (SELECT token, count(*) AS df FROM train GROUP BY token),
test AS (SELECT doc_id, token, count(*) AS n FROM alltok WHERE held AND token IN (SELECT token FROM tdf) GROUP BY ALL),
edf AS (SELECT token, count(*) AS df FROM test GROUP BY token)
"""


def _split_tokens(spark, d):
    a = articles(spark, d)
    train, test = a.where("split = 'train'"), a.where("split = 'test'")
    return train, test, doc_words(train), doc_words(test)


@query(
    "x7_tfidf_transform",
    _TRANSFORM_SQL + """SELECT doc_id, test.token, round((1.0::DOUBLE + log10(n)) * log10((SELECT count(*) FROM documents WHERE doc_id % 5 = 0) / CAST(df AS DOUBLE)), 6) AS tfidf
        FROM test JOIN edf ON test.token = edf.token""",
)
def x7(spark, d):
    train, test, a, b = _split_tokens(spark, d)
    out = terms.tfidf_transform(b, test, a.select("token").distinct())
    return out.select("doc_id", "token", F.round("tfidf", 6).alias("tfidf"))


@query(
    "x7_tfidf_transform_reuse",
    _TRANSFORM_SQL + """SELECT doc_id, test.token, round((1.0::DOUBLE + log10(n)) * log10((SELECT count(*) FROM documents WHERE doc_id % 5 <> 0) / CAST(df AS DOUBLE)), 6) AS tfidf
        FROM test JOIN tdf ON test.token = tdf.token""",
)
def x7_reuse(spark, d):
    from tidewell.functions.numeric import idf

    train, test, a, b = _split_tokens(spark, d)
    n = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    fitted = terms.document_frequency(terms.term_counts(a)).select("token", idf(n, F.col("df")).alias("idf"))
    out = terms.tfidf_transform(b, test, fitted, fitted)
    return out.select("doc_id", "token", F.round("tfidf", 6).alias("tfidf"))


_TRIPLES_SQL = f"{_TF}, v AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM df), tri AS (SELECT doc_id AS row, idx AS col, n AS value FROM tf JOIN v ON tf.token = v.token)"


def _triples(spark, d):
    """(row, col, value), and the columns: every word of the vocabulary is one."""
    from tidewell.session import cut_lineage

    tokens = _tokens(spark, d)
    vocab = cut_lineage(terms.vocabulary(tokens))
    named = terms.term_counts(tokens).join(vocab, "token")
    return named.select(F.col("doc_id").alias("row"), F.col("idx").alias("col"), F.col("n").alias("value")), vocab.select(F.col("idx").alias("col"))


@query(
    "x8_csr",
    f"""WITH {_TRIPLES_SQL}, r AS (SELECT row, count(*) AS n, string_agg(CAST(col AS VARCHAR), ',' ORDER BY col) AS indices, string_agg(CAST(value AS VARCHAR), ',' ORDER BY col) AS data FROM tri GROUP BY row)
        SELECT row, indices, data, CAST(sum(n) OVER (ORDER BY row) - n AS BIGINT) AS start, CAST(sum(n) OVER (ORDER BY row) AS BIGINT) AS "end" FROM r""",
)
def x8(spark, d):
    c = terms.csr_rows(_triples(spark, d)[0])
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")
    return c.select("row", text("indices").alias("indices"), text("data").alias("data"), "start", "end")


@query("x9_sparse_product", f"WITH {_TRIPLES_SQL} SELECT row, sum(value * (col % 7 + 1))::BIGINT AS product FROM tri GROUP BY row")
def x9(spark, d):
    t, columns = _triples(spark, d)
    w = columns.withColumn("weight", F.col("col") % 7 + 1)
    return terms.sparse_times_dense(t, w)


@query(
    "j7_sparse_dense",
    f"""WITH {_TRIPLES_SQL} SELECT row, CAST(k AS INTEGER) AS class_id, round(sum(value * ((col * (k + 1)) % 11 - 5)), 6)::DOUBLE AS product
        FROM tri CROSS JOIN (SELECT unnest(range(0, 3)) AS k) GROUP BY row, k""",
)
def j7(spark, d):
    t, columns = _triples(spark, d)
    w = columns.withColumn("class_id", F.explode(F.sequence(F.lit(0), F.lit(2))))
    w = w.withColumn("weight", ((F.col("col") * (F.col("class_id") + 1)) % 11 - 5).cast("double"))
    return terms.sparse_times_dense(t, w, ["class_id"]).select("row", "class_id", F.round("product", 6).alias("product"))


def _near_sql(w: int, weight: str = "1") -> str:
    return f"""
pos AS (SELECT doc_id, unnest(t) AS token, unnest(range(0, len(t))) AS p FROM (SELECT doc_id, {WORDS_SQL} AS t FROM documents) WHERE len(t) > 0),
fwd AS (SELECT a.token AS a, b.token AS b, {weight.replace('DIST', '(b.p - a.p)')} AS w FROM pos a JOIN
        (SELECT *, p - k AS q FROM pos CROSS JOIN (SELECT unnest(range(1, {w + 1})) AS k)) b ON a.doc_id = b.doc_id AND a.p = b.q),
pairs AS (SELECT a, b, sum(w) AS n FROM (SELECT a, b, w FROM fwd UNION ALL SELECT b, a, w FROM fwd) GROUP BY a, b)
"""


def _word_arrays(spark, d):
    return _docs(spark, d).select("doc_id", tx.words(F.col("text")).alias("t"))


@query("x10_window_cooccurrence", f"WITH {_near_sql(3)} SELECT a, b, n::BIGINT AS n FROM pairs")
def x10(spark, d):
    return co.cooccurrence(_word_arrays(spark, d), "t", 3)


@query("j6_band_pairs", f"WITH {_near_sql(2)} SELECT a, count(*) AS n_contexts, sum(n)::BIGINT AS n_pairs FROM pairs GROUP BY a")
def j6(spark, d):
    p = co.cooccurrence(_word_arrays(spark, d), "t", 2)
    return p.groupBy("a").agg(F.count(F.lit(1)).alias("n_contexts"), F.sum("n").alias("n_pairs"))


@query(
    "e9_distance_cooccurrence",
    f"WITH {_near_sql(10, '1.0::DOUBLE / DIST')} SELECT a, count(*) AS n_contexts, round(sum(n), 4) AS weight FROM pairs GROUP BY a",
)
def e9(spark, d):
    p = co.cooccurrence(_word_arrays(spark, d), "t", 10, distance_weight=True)
    return p.groupBy("a").agg(F.count(F.lit(1)).alias("n_contexts"), F.round(F.sum("n"), 4).alias("weight"))


@query(
    "x11_sentence_cooccurrence",
    f"""WITH s AS (SELECT doc_id, unnest({_SENT_SQL}) AS text FROM documents),
        n AS (SELECT row_number() OVER () AS sid, {WORDS_SQL} AS t FROM s),
        w AS (SELECT DISTINCT sid, unnest(t) AS token FROM n)
        SELECT a.token AS a, b.token AS b, count(*) AS n FROM w a JOIN w b ON a.sid = b.sid AND a.token < b.token GROUP BY ALL""",
)
def x11(spark, d):
    s = _docs(spark, d).select(F.explode(tx.sentences(F.col("text"))).alias("s")).select(tx.words(F.col("s")).alias("w"))
    return co.sentence_cooccurrence(s, "w")


@query("x12_document_cooccurrence", f"WITH {_TF} SELECT token, count(*) AS n_docs, sum(n)::BIGINT AS n, max(n) AS most FROM tf GROUP BY token")
def x12(spark, d):
    """Word by document counts, summed up per word."""
    return terms.term_counts(_tokens(spark, d)).groupBy("token").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n"), F.max("n").alias("most")
    )


@query(
    "x13_pmi",
    f"""WITH {_near_sql(3)}, m AS (SELECT a, sum(n) AS na FROM pairs GROUP BY a)
        SELECT p.a, p.b, p.n::BIGINT AS n, round(ln(CAST(p.n AS DOUBLE) * (SELECT sum(n)::DOUBLE FROM pairs) / (CAST(x.na AS DOUBLE) * y.na::DOUBLE)), 6) AS pmi,
        round(greatest(ln(CAST(p.n AS DOUBLE) * (SELECT sum(n)::DOUBLE FROM pairs) / (CAST(x.na AS DOUBLE) * y.na::DOUBLE)), 0.0::DOUBLE), 6) AS ppmi
        FROM pairs p JOIN m x ON p.a = x.a JOIN m y ON p.b = y.a""",
)
def x13(spark, d):
    # pairs, margins and total all come from the counted pairs
    p = co.pmi(co.cooccurrence(_word_arrays(spark, d), "t", 3))
    return p.select("a", "b", "n", F.round("pmi", 6).alias("pmi"), F.round("ppmi", 6).alias("ppmi"))


@query(
    "t3_top_frequent",
    f"WITH {_TOK}, c AS (SELECT token, count(*) AS n FROM tok GROUP BY token ORDER BY n DESC, token LIMIT 1000) SELECT token, n FROM c WHERE n >= 20",
)
def t3(spark, d):
    c = _tokens(spark, d).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.col("n").desc(), "token").limit(1000).where("n >= 20")


@query(
    "x20_clean_books",
    r"""WITH b AS (SELECT doc_id, 'head ' || lang || chr(10) || '*** START OF THE TEXT ***' || chr(10) || '  ' || text || '  ' || chr(10) || chr(10) || '*** END OF THE TEXT ***' || chr(10) || 'tail' AS t FROM documents),
        l AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(split_part(split_part(t, '*** START OF THE TEXT ***' || chr(10), 2), '*** END OF', 1), '\r\n|\r', chr(10), 'g'), chr(10)),
                     lambda s: regexp_replace(s, '^[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+$', '', 'g')), lambda s: s <> '') AS x FROM b)
        SELECT doc_id, CAST(len(x) AS BIGINT) AS n_lines, array_to_string(x, chr(10)) AS body FROM l""",
)
def x20(spark, d):
    nl = F.lit("\n")
    raw = F.concat(
        F.lit("head "), F.col("lang"), nl, F.lit("*** START OF THE TEXT ***"), nl, F.lit("  "), F.col("text"),
        F.lit("  "), nl, nl, F.lit("*** END OF THE TEXT ***"), nl, F.lit("tail"),
    )
    b = table(spark, d, "documents").select("doc_id", tx.clean_book(raw).alias("body"))
    return b.select("doc_id", F.size(F.filter(F.split("body", "\n"), lambda s: s != "")).cast("long").alias("n_lines"), "body")


@query(
    "f_regex_chain",
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(j,
        '[\t\n\x0B\f\r ]+([.,!?;:])', '\1', 'g'), '[\t\n\x0B\f\r ]+''[\t\n\x0B\f\r ]+', '''', 'g'), '[\t\n\x0B\f\r ]+-[\t\n\x0B\f\r ]+', '-', 'g'),
        '\([\t\n\x0B\f\r ]+', '(', 'g'), '[\t\n\x0B\f\r ]+\)', ')', 'g'), '[\t\n\x0B\f\r ]+\[', '[', 'g'), '\][\t\n\x0B\f\r ]+', ']', 'g'), ' ') AS tidy
        FROM (SELECT doc_id, array_to_string(""" + MARKS_SQL + ", ' ') AS j FROM documents)",
)
def f8(spark, d):
    joined = F.array_join(tx.words_and_marks(F.col("text")), " ")
    return _docs(spark, d).select("doc_id", tx.tidy_joined_text(joined).alias("tidy"))


@query("f_accents_fixed", "SELECT doc_id, translate(lower(text), 'àâäçéèêëîïôöùûüñß', 'aaaceeeeiioouuuns') AS folded FROM documents")
def f9_fixed(spark, d):
    return _docs(spark, d).select("doc_id", tx.fold_accents_fixed(F.lower("text"), "àâäçéèêëîïôöùûüñß", "aaaceeeeiioouuuns").alias("folded"))


@query("f_accents", "SELECT doc_id, strip_accents(text) AS folded FROM documents")
def f9(spark, d):
    return _docs(spark, d).select("doc_id", tx.fold_accents("text").alias("folded"))


@query(
    "f_markers_and_fields",
    """SELECT page_id, CAST(starts_with(url, 'https') AS INTEGER) AS is_https, strpos(html, '<body') AS body_at,
       substr(html, strpos(html, '<title>') + 7, greatest(strpos(html, '</title>') - strpos(html, '<title>') - 7, 0)) AS title FROM pages""",
)
def f10(spark, d):
    p = table(spark, d, "pages")
    a, b = F.locate("<title>", F.col("html")), F.locate("</title>", F.col("html"))
    return p.select(
        "page_id", F.startswith("url", F.lit("https")).cast("int").alias("is_https"), F.locate("<body", F.col("html")).cast("long").alias("body_at"),
        F.substr(F.col("html"), a + 7, F.greatest(b - a - 7, F.lit(0))).alias("title"),
    )


@query("f_first_text_field", "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN text ELSE role END AS chosen FROM conversations")
def f11(spark, d):
    """Every other row lacks the first field, so its second one counts."""
    first, second = [n for n in tx.TEXT_FIELDS if n != "text"][:2]
    c = table(spark, d, "conversations").select(
        "conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.col("text")).alias(first), F.col("role").alias(second)
    )
    return c.select("conv_id", "turn", tx.first_text_field(c).alias("chosen"))


@query("f_ascii_lower", "SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS ascii_low, lower(text) AS full_low FROM documents")
def f20(spark, d):
    return _docs(spark, d).select("doc_id", tx.ascii_lower(F.col("text")).alias("ascii_low"), F.lower("text").alias("full_low"))


@query("s13_labelled_corpus", "SELECT doc_id, lang AS label, n_chars FROM documents WHERE doc_id % 5 <> 0 AND lang IN ('de', 'es', 'fr')")
def s13(spark, d):
    from tidewell.sources.files import labelled_corpus

    t = table(spark, d, "documents").select(
        "doc_id", F.col("lang").alias("label"), "n_chars", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train").alias("split")
    )
    return labelled_corpus(t, "train", ["de", "es", "fr"]).select("doc_id", "label", "n_chars")


@query("p12_regex_rows", "SELECT doc_id, source FROM documents WHERE regexp_matches(text, '(?i)benchmark|license')")
def p12(spark, d):
    t = table(spark, d, "documents")
    return t.where(F.col("text").rlike("(?i)benchmark|license")).select("doc_id", "source")


# ---- classification ----
def _train_test(spark, d):
    """TF-IDF triples of both splits over the training vocabulary, written once for the solver's passes."""
    from tidewell.session import cut_lineage

    train, test, a, b = _split_tokens(spark, d)
    vocab = cut_lineage(terms.vocabulary(a))
    tri = lambda x: cut_lineage(
        x.join(vocab, "token").select(F.col("doc_id").alias("row"), F.col("idx").alias("col"), F.col("tfidf").alias("value"))
    )
    return train, test, tri(terms.tfidf(a, train)), tri(terms.tfidf_transform(b, test, vocab)), vocab


def _fit(spark, d):
    train, test, tri_a, tri_b, vocab = _train_test(spark, d)
    from tidewell.operators.ordered import sorted_index

    classes = sorted_index(train.select("label").distinct(), "label", "class_id")
    labelled = train.select("doc_id", "label").join(classes, "label").withColumn("y", F.col("class_id").cast("double"))
    coef, intercept = cl.fit_multinomial(cl.feature_vectors(tri_a, labelled, vocab.count()), "y")
    return test, tri_b, vocab, classes, coef, intercept


def _predictions(spark, d):
    test, tri_b, vocab, classes, coef, intercept = _fit(spark, d)
    p = cl.predict(cl.logits(tri_b, test, coef, intercept))
    named = p.join(classes.select(F.col("class_id").cast("int").alias("predicted"), F.col("label").alias("predicted_label")), "predicted")
    return named.join(test.select("doc_id", "label"), "doc_id")


@query("x14_multinomial_fit")
def x14(spark, d):
    """The weight of every word in every class."""
    test, tri_b, vocab, classes, coef, intercept = _fit(spark, d)
    c = classes.select(F.col("class_id").cast("int").alias("class_id"), "label")
    w = coef.join(vocab.select(F.col("idx").alias("col"), "token"), "col").join(c, "class_id")
    return w.select(F.col("label").alias("class"), "token", F.round("weight", 4).alias("weight"))


@query("x15_predict")
def x15(spark, d):
    return _predictions(spark, d).select("doc_id", "label", "predicted_label", F.round("probability", 4).alias("probability"))


@query("x17_report_of_fit")
def x17_fit(spark, d):
    r = cl.classification_report(_predictions(spark, d), "label", "predicted_label")
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "x16_top_words",
    f"""WITH tok AS (SELECT lang AS class, unnest({WORDS_SQL}) AS token FROM documents),
        c AS (SELECT class, token, count(*) AS weight FROM tok GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY weight DESC, token) AS rank FROM c)
        SELECT class, token, weight, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
)
def x16(spark, d):
    t = table(spark, d, "documents").select(F.col("lang").alias("class"), F.explode(tx.words(F.col("text"))).alias("token"))
    return cl.top_words(t.groupBy("class", "token").agg(F.count(F.lit(1)).alias("weight")), 10)


# a stand-in classifier: wrong for about a third of the documents
_PRED_SQL = f"pred AS (SELECT doc_id, lang AS actual, CASE WHEN {mix_sql('doc_id', seed=3)} % 3 = 0 THEN ['de','en','es','fr'][{mix_sql('doc_id', seed=4)} % 4 + 1] ELSE lang END AS predicted FROM documents)"


def _pred(spark, d):
    wrong = F.element_at(F.array(*[F.lit(x) for x in ("de", "en", "es", "fr")]), (mix(F.col("doc_id"), seed=4) % 4 + 1).cast("int"))
    return table(spark, d, "documents").select(
        "doc_id", F.col("lang").alias("actual"), F.when(mix(F.col("doc_id"), seed=3) % 3 == 0, wrong).otherwise(F.col("lang")).alias("predicted")
    )


@query(
    "x17_classification_report",
    f"""WITH {_PRED_SQL}, c AS (SELECT k.label, count_if(actual = k.label)::DOUBLE AS support, count_if(predicted = k.label)::DOUBLE AS claimed, count_if(actual = k.label AND predicted = k.label)::DOUBLE AS hit
          FROM pred, (SELECT DISTINCT lang AS label FROM documents) k GROUP BY k.label),
        s AS (SELECT label, hit / claimed AS p, hit / support AS r, 2 * hit / (claimed + support) AS f, support FROM c)
        SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support::BIGINT AS support FROM s
        UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), sum(support)::BIGINT FROM c
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM s
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM s""",
)
def x17(spark, d):
    r = cl.classification_report(_pred(spark, d), "actual", "predicted")
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "x18_confusion",
    f"""WITH {_PRED_SQL}, k AS (SELECT DISTINCT lang AS label FROM documents)
        SELECT a.label AS actual, b.label AS predicted, (SELECT count(*) FROM pred WHERE pred.actual = a.label AND pred.predicted = b.label) AS n FROM k a CROSS JOIN k b""",
)
def x18(spark, d):
    return cl.confusion(_pred(spark, d), "actual", "predicted")


_LOGIT_SQL = f"z AS (SELECT doc_id, lang, {normal_sql('doc_id', '0', seed=8)} AS z0, {normal_sql('doc_id', '1', seed=8)} AS z1, {normal_sql('doc_id', '2', seed=8)} AS z2 FROM documents)"


def _logits(spark, d):
    z = [normal(F.col("doc_id"), F.lit(k), seed=8) for k in range(3)]
    return table(spark, d, "documents").select("doc_id", "lang", F.array(*z).alias("z"))


@query(
    "x19_loglik_odds",
    f"""WITH {_LOGIT_SQL} SELECT lang, round(sum(z0 - ln(exp(z0) + exp(z1) + exp(z2))), 5) AS loglik, round(avg(exp(z0 - z1)), 6) AS odds_01 FROM z GROUP BY lang""",
)
def x19(spark, d):
    z = _logits(spark, d).select("lang", "z", log_softmax(F.col("z")).alias("lp"))
    return z.groupBy("lang").agg(
        F.round(F.sum(F.element_at("lp", 1)), 5).alias("loglik"),
        F.round(F.avg(F.exp(F.element_at("z", 1) - F.element_at("z", 2))), 6).alias("odds_01"),
    )


@query("a14_correlation", f"WITH {_LOGIT_SQL} SELECT lang, round(corr(z0, z0 + z1), 6) AS r FROM z GROUP BY lang")
def a14(spark, d):
    z = _logits(spark, d).select("lang", F.element_at("z", 1).alias("z0"), F.element_at("z", 2).alias("z1"))
    return z.groupBy("lang").agg(F.round(F.corr("z0", F.col("z0") + F.col("z1")), 6).alias("r"))


@query(
    "a11_mode",
    f"""WITH t AS (SELECT lang, length(unnest({WORDS_SQL})) AS n FROM documents), c AS (SELECT lang, n, count(*) AS k FROM t GROUP BY ALL)
        SELECT lang, CAST(n AS INTEGER) AS mode FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k DESC, n) AS r FROM c) WHERE r = 1""",
)
def a11(spark, d):
    from tidewell.operators.summaries import mode_smallest

    w = table(spark, d, "documents").select("lang", F.explode(tx.words(F.col("text"))).alias("w"))
    t = w.select("lang", F.length("w").alias("n"))
    return mode_smallest(t, ["lang"], "n")
