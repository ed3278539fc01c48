"""Subword jobs and token-stream preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import text as tx
from tidewell.functions.hashing import mix_sql, uniform_sql
from tidewell.functions.numeric import pad_to
from tidewell.operators import corpus as cp
from tidewell.operators import wordpiece as wp
from tidewell.plans.base import query, table
from tidewell.session import spread
from tidewell.plans.standins import MARKS_SQL, SPACES_SQL, plain_texts


def _docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def _str(c, sep=","):
    return F.array_join(F.transform(c, lambda v: v.cast("string")), sep)


_CNT = f"cnt AS (SELECT word, count(*) AS n FROM (SELECT unnest({MARKS_SQL}) AS word FROM documents) GROUP BY word)"
_PIECES = f"{_CNT}, pc AS (SELECT word, n, list_transform(string_split(word, ''), lambda c, i: CASE WHEN i = 1 THEN c ELSE '##' || c END) AS p FROM cnt)"


@query("k1_word_counts", f"WITH {_CNT} SELECT word, n FROM cnt")
def k1(spark, d):
    return wp.word_counts(_docs(spark, d))


@query("k2_initial_pieces", f"WITH {_PIECES} SELECT word, array_to_string(p, ' ') AS pieces FROM pc")
def k2(spark, d):
    return wp.word_counts(_docs(spark, d)).select("word", F.array_join(wp.initial_pieces(F.col("word")), " ").alias("pieces"))


@query(
    "k3_pair_scores",
    f"""WITH {_PIECES}, t AS (SELECT t, sum(n) AS f FROM (SELECT unnest(p) AS t, n FROM pc) GROUP BY t),
        pr AS (SELECT z[1] AS a, z[2] AS b, sum(n) AS freq FROM (SELECT unnest(list_zip(p[:-2], p[2:])) AS z, n FROM pc WHERE len(p) > 1) GROUP BY ALL HAVING sum(n) >= 2)
        SELECT a, b, freq::BIGINT AS freq, round(freq::DOUBLE / (x.f::DOUBLE * y.f::DOUBLE) * 1e6::DOUBLE, 6) AS score_ppm FROM pr JOIN t x ON x.t = a JOIN t y ON y.t = b""",
)
def k3(spark, d):
    words = wp.word_counts(_docs(spark, d)).withColumn("pieces", wp.initial_pieces(F.col("word")))
    return wp.pair_scores(words).select("a", "b", "freq", F.round(F.col("score") * F.lit(1e6), 6).alias("score_ppm"))


def _merge_rounds(rounds):
    """SQL for the first merges: pieces as text between blanks, a round per common table."""
    steps = [f"""r0 AS MATERIALIZED (SELECT word, n, array_to_string(list_transform(p, lambda c: ' ' || c || ' '), '') AS s FROM pc)"""]
    for i in range(rounds):
        steps.append(f"""q{i} AS MATERIALIZED (SELECT word, n, string_split(trim(s, ' '), '  ') AS p FROM r{i}),
        t{i} AS (SELECT t, sum(n) AS f FROM (SELECT unnest(p) AS t, n FROM q{i}) GROUP BY t),
        b{i} AS MATERIALIZED (SELECT a, b, freq::DOUBLE / (x.f::DOUBLE * y.f::DOUBLE) AS score FROM
          (SELECT z[1] AS a, z[2] AS b, sum(n) AS freq FROM (SELECT unnest(list_zip(p[:-2], p[2:])) AS z, n FROM q{i} WHERE len(p) > 1) GROUP BY ALL HAVING sum(n) >= 2)
          JOIN t{i} x ON x.t = a JOIN t{i} y ON y.t = b ORDER BY score DESC, a, b LIMIT 1),
        r{i + 1} AS MATERIALIZED (SELECT word, n, replace(s, ' ' || a || '  ' || b || ' ', ' ' || a || b[3:] || ' ') AS s FROM r{i}, b{i})""")
    rows = " UNION ALL ".join(f"SELECT {i}::INTEGER AS rank, a, b, a || b[3:] AS merged, score FROM b{i}" for i in range(rounds))
    return f"WITH {_PIECES}, {', '.join(steps)} {rows}"


def _merges_of(spark, d, size):
    from tidewell.session import cut_lineage

    vocab, merges = wp.train(cut_lineage(wp.word_counts(_docs(spark, d))), size)
    rows = [(i, a, b, m, float(s)) for i, (a, b, m, s) in enumerate(merges)]
    return vocab, spark.createDataFrame(rows, "rank int, a string, b string, merged string, score double")


@query("k4_first_merges", _merge_rounds(8))
def k4_first(spark, d):
    """The first merges, of which SQL can follow a few."""
    return _merges_of(spark, d, VOCABULARY)[1].where("rank < 8")


#: Entries of a trained vocabulary.
VOCABULARY = 4000


@query("k4_merges")
def k4(spark, d):
    """All merges up to a vocabulary of four thousand entries."""
    return _merges_of(spark, d, VOCABULARY)[1]


@query("k5_vocabulary_with_specials")
def k5(spark, d):
    """Both rules: special tokens first and in the size, or sorted entries cut to the size."""
    from tidewell.session import cut_lineage

    counts = cut_lineage(wp.word_counts(_docs(spark, d)))
    out = None
    for rule in ("appended", "sorted"):
        vocab, _ = wp.train(counts, VOCABULARY, rule=rule)
        own = wp.vocab_table(spark, vocab).withColumn("rule", F.lit(rule))
        out = own if out is None else out.unionByName(own)
    return out


# a vocabulary by rule, so that SQL can follow the encoding: frequent words whole, single
# characters otherwise, and no continuation 'x' (words that need it are unknown)
_RULE = f"""{_CNT}, ch AS (SELECT DISTINCT unnest(string_split(word, '')) AS c FROM cnt),
rule AS (SELECT word AS token FROM cnt WHERE n >= 50 UNION SELECT c FROM ch UNION SELECT '##' || c FROM ch WHERE c <> 'x'),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY token) + 4 AS INTEGER) AS id FROM rule
  UNION ALL SELECT unnest(['[PAD]', '[UNK]', '[CLS]', '[SEP]', '[MASK]']), unnest([0, 1, 2, 3, 4]))"""


def _rule_vocab(spark, d):
    from tidewell.operators.ordered import sorted_index
    from tidewell.session import cut_lineage

    counts = cut_lineage(wp.word_counts(_docs(spark, d)))
    ch = counts.select(F.explode(F.regexp_extract_all("word", F.lit("(?s)."), F.lit(0))).alias("c")).distinct()
    rule = (
        counts.where("n >= 50").select(F.col("word").alias("token")).union(ch)
        .union(ch.where("c <> 'x'").select(F.concat(F.lit("##"), "c"))).distinct()
    )
    ids = sorted_index(rule, "token", "i").select("token", (F.col("i") + 5).cast("int").alias("id"))
    return cut_lineage(wp.vocab_table(spark, wp.SPECIALS).unionByName(ids))


_SEG = f"""{_RULE}, pre AS (
  SELECT word, max(k) AS k FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM cnt) WHERE k = 1 OR left(word, k) IN (SELECT word FROM cnt WHERE n >= 50) GROUP BY word),
seg AS (SELECT word, CASE WHEN contains(word[k + 1:], 'x') THEN ['[UNK]']
   WHEN k = length(word) THEN [word] ELSE list_concat([left(word, k)], list_transform(string_split(word[k + 1:], ''), lambda c: '##' || c)) END AS p,
   k FROM pre),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM (SELECT doc_id, {MARKS_SQL} AS w FROM documents) WHERE len(w) > 0),
enc AS (SELECT doc_id, i, unnest(p) AS token, unnest(range(0, len(p))) AS j FROM dw JOIN seg ON dw.word = seg.word)"""


@query(
    "k6_encode",
    f"""WITH {_SEG} SELECT d.doc_id, count(token) AS n_pieces, coalesce(string_agg(token, ' ' ORDER BY i, j), '') AS tokens
        FROM documents d LEFT JOIN enc ON enc.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def k6(spark, d):
    e = wp.encode(_docs(spark, d), _rule_vocab(spark, d))
    return e.select("doc_id", F.size("tokens").cast("long").alias("n_pieces"), F.array_join("tokens", " ").alias("tokens"))


@query("k6_segment_words_by_join", f"WITH {_SEG} SELECT word, array_to_string(p, ' ') AS tokens FROM seg")
def k6_join(spark, d):
    words = wp.word_counts(_docs(spark, d))
    s = wp.segment_words(words, _rule_vocab(spark, d))
    return s.select("word", F.array_join(F.transform("pieces", lambda x: x["token"]), " ").alias("tokens"))


@query(
    "k7_offsets",
    f"""WITH RECURSIVE {_SEG}, gap AS (SELECT doc_id, list_transform(regexp_split_to_array(lower(text), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]'), lambda g: length(g)) AS g, {MARKS_SQL} AS w FROM documents),
        gw AS (SELECT doc_id, unnest(w) AS word, unnest(g[1:len(w)]) AS g, unnest(range(0, len(w))) AS i FROM gap WHERE len(w) > 0),
        wat AS (SELECT doc_id, word, i, sum(g + length(word)) OVER (PARTITION BY doc_id ORDER BY i) - length(word) AS s FROM gw)
        SELECT doc_id, count(*) AS n_words, sum(s * (i % 97 + 1))::BIGINT AS start_sum, sum((s + length(word)) * (i % 89 + 1))::BIGINT AS end_sum FROM wat GROUP BY doc_id""",
)
def k7(spark, d):
    """Word starts and ends put together again from the pieces' offsets."""
    e = wp.encode(_docs(spark, d), _rule_vocab(spark, d))
    z = e.select("doc_id", F.posexplode(F.arrays_zip("tokens", "starts", "ends")).alias("p", "z"))
    z = z.select("doc_id", "p", F.col("z.tokens").alias("t"), F.col("z.starts").alias("s"), F.col("z.ends").alias("e"))
    heads = e.select("doc_id", F.filter(F.arrays_zip("tokens", "starts"), lambda x: ~x["tokens"].startswith("##")).alias("h"), F.arrays_zip("tokens", "ends").alias("a"))
    n = F.size("a")
    nxt = F.concat(F.slice("a", F.lit(2), F.greatest(n, F.lit(1))), F.array(F.struct(F.lit("end").alias("tokens"), F.lit(0).alias("ends"))))
    tails = F.filter(F.arrays_zip(F.col("a").alias("x"), nxt.alias("y")), lambda v: ~v["y"]["tokens"].startswith("##"))
    pairs = heads.where(n > 0).select("doc_id", F.posexplode(F.arrays_zip(F.col("h").alias("h"), tails.alias("t"))).alias("i", "v"))
    return pairs.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_words"),
        F.sum(F.col("v.h.starts") * (F.col("i") % 97 + 1)).alias("start_sum"),
        F.sum(F.col("v.t.x.ends") * (F.col("i") % 89 + 1)).alias("end_sum"),
    )


@query(
    "k8_specials_and_masks",
    f"""WITH {_SEG} SELECT d.doc_id, '[CLS] ' || coalesce(string_agg(token, ' ' ORDER BY i, j) || ' ', '') || '[SEP]' AS tokens,
        CAST(count(token) + 2 AS BIGINT) AS attention, '1' || repeat('0', count(token)) || '1' AS special_mask FROM documents d LEFT JOIN enc ON enc.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def k8(spark, d):
    s = wp.add_specials(wp.encode(_docs(spark, d), _rule_vocab(spark, d)))
    return s.select(
        "doc_id", F.array_join("tokens", " ").alias("tokens"),
        F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("attention"), _str(F.col("special_tokens_mask"), "").alias("special_mask"),
    )


@query(
    "k9_pair_template",
    f"""WITH t AS (SELECT conv_id, turn, role, {MARKS_SQL} AS w FROM conversations)
        SELECT a.conv_id, a.turn, array_to_string(list_concat(['[CLS]'], a.w, ['[SEP]'], b.w, ['[SEP]']), ' ') AS tokens,
        repeat('0', len(a.w) + 2) || repeat('1', len(b.w) + 1) AS type_ids FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
        WHERE a.role = 'user' AND b.role = 'assistant'""",
)
def k9(spark, d):
    t = table(spark, d, "conversations").select("conv_id", "turn", "role", tx.words_and_marks(F.col("text")).alias("w"))
    a = t.where("role = 'user'").select("conv_id", "turn", F.col("w").alias("a"))
    b = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("b"))
    tokens, types = wp.pair_template(F.col("a"), F.col("b"), F.lit("[CLS]"), F.lit("[SEP]"))
    return a.join(b, ["conv_id", "turn"]).select("conv_id", "turn", F.array_join(tokens, " ").alias("tokens"), _str(types, "").alias("type_ids"))


_TIDY_SQL = "trim(" + "regexp_replace(" * 7 + "{x}" + r""", '[\t\n\x0B\f\r ]+([.,!?;:])', '\1', 'g'), '[\t\n\x0B\f\r ]+''[\t\n\x0B\f\r ]+', '''', 'g'), '[\t\n\x0B\f\r ]+-[\t\n\x0B\f\r ]+', '-', 'g'),
 '\([\t\n\x0B\f\r ]+', '(', 'g'), '[\t\n\x0B\f\r ]+\)', ')', 'g'), '[\t\n\x0B\f\r ]+\[', '[', 'g'), '\][\t\n\x0B\f\r ]+', ']', 'g'), ' ')"""


@query(
    "k10_decode",
    f"""WITH {_SEG}, words AS (SELECT dw.doc_id, dw.i, dw.word FROM dw JOIN seg ON dw.word = seg.word WHERE NOT contains(seg.word[seg.k + 1:], 'x')),
        j AS (SELECT d.doc_id, coalesce(string_agg(word, ' ' ORDER BY i), '') AS t FROM documents d LEFT JOIN words ON words.doc_id = d.doc_id GROUP BY d.doc_id)
        SELECT doc_id, {_TIDY_SQL.format(x='t')} AS decoded FROM j""",
)
def k10(spark, d):
    """Round trip: encode, add specials, decode without them; unknown words are left out."""
    vocab = _rule_vocab(spark, d)
    s = wp.add_specials(wp.encode(_docs(spark, d), vocab))
    return wp.decode(s.select("doc_id", "ids"), "ids", vocab, skip="id").select("doc_id", "decoded")


@query(
    "u3_tokenizer",
    f"""WITH j AS (SELECT doc_id, coalesce(array_to_string({MARKS_SQL}, ' '), '') AS t FROM documents)
        SELECT doc_id, {_TIDY_SQL.format(x='t')} AS decoded, true AS same_after_reload FROM j""",
)
def u3(spark, d):
    """Train, save, load, encode and decode: every character is in the vocabulary, so words come back whole."""
    from pyspark.ml import Pipeline, PipelineModel
    from tidewell.session import scratch_path

    docs = _docs(spark, d).select("doc_id", "text")
    fitted = Pipeline(stages=[wp.SubwordTokenizer(VOCABULARY)]).fit(docs)
    path = scratch_path(spark, "tokenizer")
    fitted.write().save(path)
    again = PipelineModel.load(path).stages[0]
    encoded = fitted.transform(docs).select("doc_id", "text", F.col("ids").alias("first"))
    same = again.transform(encoded).withColumn("same", F.col("ids") == F.col("first"))
    same_names = F.lit(again.get_vocab() == fitted.stages[0].get_vocab())
    return again.decode(same.select("doc_id", "ids", "same")).select(
        "doc_id", "decoded", (F.col("same") & same_names).alias("same_after_reload")
    )


@query("k11_export_vocabulary", f"WITH {_RULE} SELECT token, id FROM vocab")
def k11(spark, d):
    return _rule_vocab(spark, d)


@query(
    "k12_batch_encode",
    f"""WITH {_SEG}, x AS (SELECT enc.doc_id, i, j, v.id FROM enc JOIN vocab v ON v.token = enc.token)
        SELECT d.doc_id, '2,' || coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY i, j) || ',', '') || '3' AS ids, count(id) + 2 AS n_mask
        FROM documents d LEFT JOIN x ON x.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def k12(spark, d):
    s = wp.add_specials(wp.encode(_docs(spark, d), _rule_vocab(spark, d)))
    return s.select("doc_id", _str(F.col("ids")).alias("ids"), F.size("attention_mask").cast("long").alias("n_mask"))


# ---- token streams ----
_SP = f"sp AS (SELECT doc_id, {SPACES_SQL} AS t FROM documents), spt AS (SELECT doc_id, unnest(t) AS token, unnest(range(0, len(t))) AS p FROM sp WHERE len(t) > 0)"
_LV = f"""{_SP}, lc AS (SELECT token, count(*) AS n FROM spt GROUP BY token ORDER BY n DESC, token LIMIT 100000),
lv AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id FROM lc WHERE n >= 20)"""


def _space_docs(spark, d):
    return _docs(spark, d).select("doc_id", tx.split_spaces(F.col("text")).alias("tokens"))


def _word_vocab(spark, d):
    return cp.word_vocabulary(_space_docs(spark, d).select(F.explode("tokens").alias("token")))


@query("l1_word_vocabulary", f"WITH {_LV} SELECT token, id FROM lv UNION ALL SELECT '<pad>', 0 UNION ALL SELECT '<unk>', 1")
def l1(spark, d):
    return _word_vocab(spark, d)


_ALPHA = cp.ALPHABET.replace("'", "''")
_CHAR_SQL = f"list_transform(range(1, 9), lambda k: CASE WHEN k > length(token) THEN 0 WHEN strpos('{_ALPHA}', substr(token, k, 1)) > 0 THEN strpos('{_ALPHA}', substr(token, k, 1)) + 1 ELSE 1 END)"


@query("l2_char_ids", f"WITH {_SP} SELECT DISTINCT token, array_to_string({_CHAR_SQL}, ',') AS chars FROM spt")
def l2(spark, d):
    w = _space_docs(spark, d).select(F.explode("tokens").alias("token")).distinct()
    return w.select("token", _str(cp.char_ids(F.col("token"), 8)).alias("chars"))


@query(
    "l3_windows",
    f"""WITH {_SP}, g AS (SELECT token, row_number() OVER (ORDER BY doc_id, p) - 1 AS g FROM spt),
        w AS (SELECT g // 64 AS "window", string_agg(token, ' ' ORDER BY g) AS inputs, count(*) AS n FROM g GROUP BY 1)
        SELECT "window", inputs FROM w WHERE ("window" + 1) * 64 < (SELECT count(*) FROM spt)""",
)
def l3(spark, d):
    w = cp.windows(cp.chain(_space_docs(spark, d)), 64)
    return w.select("window", F.array_join("inputs", " ").alias("inputs"))


_CH = f"""{_SP}, cht AS (SELECT doc_id, p, token FROM spt UNION ALL SELECT doc_id, 1000000000, '<|endoftext|>' FROM sp WHERE doc_id < (SELECT max(doc_id) FROM sp)),
chg AS (SELECT doc_id, token, row_number() OVER (ORDER BY doc_id, p) - 1 AS g FROM cht)"""


@query("l4_chained_documents", f"WITH {_CH}, s AS (SELECT doc_id, count(*) AS n_tokens, min(g) AS start FROM chg GROUP BY doc_id) SELECT doc_id, n_tokens, start FROM s")
def l4(spark, d):
    c = cp.chain(_space_docs(spark, d), separator=cp.SEPARATOR)
    return c.where(F.size("tokens") > 0).select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), "start")


@query(
    "l5_sliding_windows",
    f"""WITH {_CH}, k AS (SELECT unnest(range(0, 128)) AS o), n AS (SELECT count(*) AS n FROM chg),
        s AS (SELECT unnest(range(0, greatest((n - 128 - 1) // 96 + 1, 0))) AS "window" FROM n)
        SELECT "window", string_agg(a.token, ' ' ORDER BY o) AS inputs, string_agg(b.token, ' ' ORDER BY o) AS targets
        FROM s CROSS JOIN k JOIN chg a ON a.g = "window" * 96 + o JOIN chg b ON b.g = "window" * 96 + o + 1 GROUP BY "window" """,
)
def l5(spark, d):
    w = cp.windows(cp.chain(_space_docs(spark, d), separator=cp.SEPARATOR), 128, 96)
    return w.select("window", F.array_join("inputs", " ").alias("inputs"), F.array_join("targets", " ").alias("targets"))


_IDDOC = f"""{_LV}, li AS (SELECT spt.doc_id, p, coalesce(lv.id, 1) AS id FROM spt LEFT JOIN lv ON lv.token = spt.token)"""


def _id_rows(spark, d):
    from tidewell.session import cut_lineage

    rows = _space_docs(spark, d).select("doc_id", F.posexplode("tokens").alias("pos", "token"))
    vocab = cut_lineage(_word_vocab(spark, d)).where("id > 1")
    return rows.join(vocab, "token", "left").select("doc_id", "pos", F.coalesce("id", F.lit(1)).alias("id"))


def _id_docs(spark, d):
    g = _id_rows(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("r"))
    return g.select("doc_id", F.transform("r", lambda x: x["id"]).alias("ids"))


@query("l6_truncate", f"WITH {_IDDOC} SELECT doc_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY p) AS ids, count(*) AS n FROM li WHERE p < 128 GROUP BY doc_id")
def l6(spark, d):
    t = _id_docs(spark, d).select("doc_id", F.slice("ids", 1, 128).alias("ids"))
    return t.select("doc_id", _str(F.col("ids")).alias("ids"), F.size("ids").cast("long").alias("n"))


_BATCH = f"""{_IDDOC}, di AS (SELECT doc_id, count(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY p) AS ids FROM li WHERE p < 128 GROUP BY doc_id),
b AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch FROM di), bb AS (SELECT *, max(n) OVER (PARTITION BY batch) AS m FROM b WHERE batch < (SELECT count(*) // 32 FROM di))"""


@query(
    "l7_dynamic_padding",
    f"WITH {_BATCH} SELECT doc_id, batch, m AS padded_len, ids || repeat(',0', m - n) AS ids, repeat('1', n) || repeat('0', m - n) AS mask FROM bb",
)
def l7(spark, d):
    p = cp.pad_batches(cp.batches(_id_docs(spark, d), "doc_id", 32), "ids", 128)
    return p.select("doc_id", "batch", F.col("padded_len").cast("long").alias("padded_len"), _str(F.col("ids")).alias("ids"), _str(F.col("mask"), "").alias("mask"))


@query("t9_batches", "WITH b AS (SELECT conv_id, turn, text, row_number() OVER (ORDER BY conv_id * 1000 + turn) - 1 AS i FROM conversations) SELECT conv_id, turn, i // 50 AS batch FROM b WHERE i // 50 < (SELECT count(*) // 50 FROM conversations)")
def t9(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", (F.col("conv_id") * 1000 + F.col("turn")).alias("k"))
    return cp.batches(c, "k", 50).select("conv_id", "turn", "batch")


@query(
    "l8_sentence_encode",
    f"""WITH {_LV}, c AS (SELECT conv_id, turn, {SPACES_SQL} AS t FROM conversations), k AS (SELECT unnest(range(1, 17)) AS k),
        x AS (SELECT conv_id, turn, k, coalesce(t[k], '') AS token, k <= len(t) AS real FROM c CROSS JOIN k)
        SELECT conv_id, turn, string_agg(CASE WHEN NOT real THEN '0' ELSE CAST(coalesce(lv.id, 1) AS VARCHAR) END, ',' ORDER BY k) AS ids,
        string_agg(array_to_string({_CHAR_SQL.replace('token', 'x.token')}, ' '), ',' ORDER BY k) AS chars FROM x LEFT JOIN lv ON lv.token = x.token GROUP BY conv_id, turn""",
)
def l8(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", tx.split_spaces(F.col("text")).alias("t"))
    fixed = c.select("conv_id", "turn", F.posexplode(pad_to(F.col("t"), 16, F.lit(""))).alias("k", "token"))
    j = fixed.join(_word_vocab(spark, d).where("id > 1"), "token", "left")
    j = j.withColumn("id", F.when(F.col("token") == "", 0).otherwise(F.coalesce("id", F.lit(1))))
    g = j.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("k", "id", cp.char_ids(F.col("token"), 8).alias("ch")))).alias("r"))
    return g.select("conv_id", "turn", _str(F.transform("r", lambda x: x["id"])).alias("ids"), F.array_join(F.transform("r", lambda x: _str(x["ch"], " ")), ",").alias("chars"))


_MASKED = f"""{_IDDOC}, mk AS (SELECT doc_id, p, id, CAST({uniform_sql('doc_id', 'p', seed=42)} < 0.15 AS INTEGER) AS sel, {uniform_sql('doc_id', 'p', seed=43)} AS how, {mix_sql('doc_id', 'p', seed=44)} % 1000 AS other FROM li),
ml AS (SELECT *, CASE WHEN sel = 0 THEN id WHEN how < 0.8 THEN 4 WHEN how < 0.9 THEN other ELSE id END AS mid FROM mk)"""


@query(
    "l9_masking",
    f"WITH {_MASKED} SELECT doc_id, count(*) AS n, sum(sel)::BIGINT AS n_selected, sum(CASE WHEN sel = 1 AND mid = 4 THEN 1 ELSE 0 END)::BIGINT AS n_mask, sum(mid * (p % 97 + 1))::BIGINT AS checksum FROM ml GROUP BY doc_id",
)
def l9(spark, d):
    m = cp.mask_tokens(_id_rows(spark, d), 1000, 4)
    return m.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("selected").alias("n_selected"),
        F.sum(F.when((F.col("selected") == 1) & (F.col("masked_id") == 4), 1).otherwise(0)).alias("n_mask"),
        F.sum(F.col("masked_id") * (F.col("pos") % 97 + 1)).alias("checksum"),
    )


@query("l10_masked_mean_loss", f"WITH {_MASKED} SELECT doc_id % 10 AS batch, round(sum(how * sel) / (sum(sel) + 1e-8::DOUBLE), 6) AS loss FROM ml GROUP BY 1")
def l10(spark, d):
    from tidewell.functions.hashing import uniform

    m = cp.mask_tokens(_id_rows(spark, d), 1000, 4)
    loss = uniform(F.col("doc_id"), F.col("pos"), seed=43)
    return m.groupBy((F.col("doc_id") % 10).alias("batch")).agg(F.round(cp.masked_mean(loss, F.col("selected")), 6).alias("loss"))


@query("l11_batch_accuracy", "WITH b AS (SELECT doc_id // 64 AS batch, avg(CASE WHEN quality = toxic THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS a FROM labels GROUP BY 1) SELECT round(avg(a), 6) AS accuracy, count(*) AS n_batches FROM b")
def l11(spark, d):
    b = table(spark, d, "labels").withColumn("batch", F.floor(F.col("doc_id") / 64))
    return cp.batch_accuracy(b, "batch", "quality", "toxic").select(F.round("accuracy", 6).alias("accuracy"), "n_batches")


@query(
    "l12_both_targets",
    f"""WITH {_SP}, x AS (SELECT doc_id, token, lead(token) OVER w AS forward, lag(token) OVER w AS backward FROM spt WINDOW w AS (PARTITION BY doc_id ORDER BY p))
        SELECT token, count(*) AS n, count(forward) AS n_forward, count(backward) AS n_backward, min(forward) AS first_forward, max(backward) AS last_backward FROM x GROUP BY token""",
)
def l12(spark, d):
    x = _space_docs(spark, d).where(F.size("tokens") > 0).select(F.inline(cp.neighbour_targets(F.col("tokens"))))
    return cp.target_summary(x)


@query("l13_content_mask", f"WITH c AS (SELECT conv_id, turn, len({SPACES_SQL}) AS n FROM conversations) SELECT conv_id, turn, repeat('1', CAST(least(n, 24) AS BIGINT)) || repeat('0', CAST(greatest(24 - n, 0) AS BIGINT)) AS mask FROM c")
def l13(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", pad_to(tx.split_spaces(F.col("text")), 24, F.lit("")).alias("t"))
    chars = F.transform("t", lambda w: cp.char_ids(w, 8))
    return c.select("conv_id", "turn", _str(cp.content_mask(chars), "").alias("mask"))


@query("t5_seeded_shuffle", f"SELECT o_orderkey, row_number() OVER (ORDER BY {mix_sql('o_orderkey', seed=42)}, o_orderkey) - 1 AS place FROM orders")
def t5(spark, d):
    return cp.shuffled_position(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("t6_buffered_shuffle", f"WITH p AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 2048 AS buffer_no FROM orders) SELECT o_orderkey, buffer_no, CAST(row_number() OVER (PARTITION BY buffer_no ORDER BY {mix_sql('o_orderkey', seed=0)}, o_orderkey) - 1 AS INTEGER) AS place FROM p")
def t6(spark, d):
    return cp.buffered_shuffle(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("t7_sample_with_replacement", f"WITH p AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS i FROM nation) SELECT CAST(k AS INTEGER) AS draw, n_nationkey FROM (SELECT unnest(range(0, 9)) AS k) JOIN p ON i = {mix_sql('k', seed=42)} % (SELECT count(*) FROM nation)")
def t7(spark, d):
    return cp.sample_with_replacement(table(spark, d, "nation").select("n_nationkey"), "n_nationkey", 9)


@query("s11_row_range", "SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i >= 1000 AND i < 2000")
def s11(spark, d):
    from tidewell.sources.files import row_range

    return row_range(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 1000, 2000)


@query("f17_arrays", f"WITH {_SP} SELECT doc_id, array_to_string(list_concat(t[1:5], list_transform(range(0, greatest(5 - len(t), 0)), lambda i: '-')), ' ') AS fixed FROM sp")
def f17(spark, d):
    return _space_docs(spark, d).select("doc_id", F.array_join(pad_to(F.col("tokens"), 5, F.lit("-")), " ").alias("fixed"))
