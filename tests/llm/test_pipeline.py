"""The pipeline's stages against plain Python."""

import itertools
import random

import corpus_pipeline
from test_operators import check_packed, plain_base, plain_codec, plain_matches, roots_of, shingle_set

SOUNDS = {"x": ["ba", "bo", "la", "mi"], "y": ["cik", "gu", "se", "zor"]}


def test_stages(spark, tmp_path):
    rng = random.Random(11)

    def text(lang, n):
        return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(3)) for _ in range(n))

    item = text("x", 14)
    spark.createDataFrame([(1, item), (2, text("y", 12)), (3, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = [(i, text(lang, 60), lang) for i, lang in enumerate(rng.choice("xy") for _ in range(160))]
    base = docs[0][1].split()
    docs += [(200 + i, " ".join(base[:-1] + [f"end{i}"]), docs[0][2]) for i in range(6)] + [(210, docs[3][1], docs[3][2])]
    docs += [(220, f"{text('x', 30)} {item} {text('x', 30)}", "x"), (221, item, "x"), (222, f"{text('y', 40)} ask a.b@c.de or +1 (743) 555-3824", "y")]
    docs += [(230, "123 456 !", "x"), (231, None, "x"), (232, "", None), (None, text("x", 50), "x")]
    frame = spark.createDataFrame([(*d, "s", len(d[1] or "")) for d in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = frame.repartition(3)
    out = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        kept.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        out.append((kept.columns, kept.collect()))
    language, single, clean, masked, packed = out
    assert all(c == corpus_pipeline.COLUMNS for c, _ in out[:4])
    assert {r["doc_id"] for r in language[1]} == {d[0] for d in docs} - {230, 231, 232}

    sets = {r["doc_id"]: shingle_set(r["text"]) for r in language[1]}
    links = [
        (a, b) for a, b in itertools.combinations([s for s in sets if s is not None], 2)
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    roots = dict(roots_of(links))
    assert {r["doc_id"] for r in single[1]} == {i for i in sets if roots.get(i, i) == i}
    assert sum(i in roots for i in sets) == 9

    items = [(1, item)]
    before = {r["doc_id"]: r["text"] for r in single[1]}
    after = {r["doc_id"]: r for r in clean[1]}
    assert set(before) - set(after) == {221}
    for i, r in after.items():
        n, hit, _ = plain_matches(before[i], items, 10)
        assert (r["text"] == before[i]) == (not hit) and len(r["text"].split()) == n - len(hit) + len(before[i].split()) - n
    assert item not in after[220]["text"] and after[220]["n_chars"] == len(after[220]["text"])

    for r in masked[1]:
        assert not plain_base(r["text"]) and (r["text"] == after[r["doc_id"]]["text"] or r["doc_id"] == 222)
    assert "[EMAIL] or [PHONE]" in next(r["text"] for r in masked[1] if r["doc_id"] == 222)
    check_packed(packed[1], [(r["doc_id"], r["text"]) for r in masked[1]], plain_codec(), 4096)


def test_empty_input(spark, tmp_path):
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.collect() == []
