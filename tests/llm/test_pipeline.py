"""The pipeline's stages against what each must decide, on planted documents."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from .test_models import brute_components, sentence
from .test_text_operators import brute_hits

pipeline = pytest.importorskip("corpus_pipeline")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng, root = random.Random(12), tmp_path_factory.mktemp("sf")
    rows, labels = [], []
    for i in range(400):
        lang = rng.choice(["en", "fr", "de"])
        text, good = sentence(rng, lang, rng.randint(30, 90)), rng.random() < 0.7
        if not good:
            text = " ".join(w + "***" for w in text.upper().split())
        rows.append((i, text, lang, "s", len(text)))
        labels.append((i, int(good), 0))
    clean = [r for r, (_, q, _) in zip(rows, labels) if q]
    bench = [(1, " ".join(sentence(rng, "en", 40).split())), (2, "short one of six words here")]
    rows += [(1000 + i, clean[i][1], clean[i][2], "copy", 1) for i in range(12)]
    rows += [(1100 + i, clean[20][1] + f" tail{i}", clean[20][2], "near", 1) for i in range(6)]
    rows += [(1200 + i, clean[30 + i][1] + " " + bench[0][1] + " " + clean[40 + i][1], clean[30 + i][2], "leak", 1) for i in range(8)]
    rows += [(1300, None, None, None, None), (1301, "", "en", "s", 0), (1302, "123 !!!", "en", "s", 1), (1000, clean[0][1], clean[0][2], "copy", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows, {i: q for i, q, _ in labels}, bench


def test_stages(spark, planted):
    sf_dir, rows, quality, bench = planted
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES:
        before = docs.select("doc_id", "text").collect()
        docs = pipeline.written(stage(spark, docs, sf_dir), name)
        after = docs.collect()
        seen[name] = ([(r.doc_id, r.text) for r in before], after)
        if name != "bpe":
            assert docs.columns == COLUMNS
    before, after = seen["language_id"]
    assert {i for i, _ in before} - {r.doc_id for r in after} == {1300, 1301, 1302} and len(after) == len(before) - 3
    before, after = seen["quality"]
    kept = {r.doc_id for r in after}
    known = [i for i, _ in before if i in quality]
    assert sum((i in kept) == bool(quality[i]) for i in known) / len(known) > 0.97
    before, after = seen["near_duplicates"]
    want = {c for _, _, c in brute_components(before)}
    assert sorted(r.doc_id for r in after) == sorted(want)
    before, after = seen["decontamination"]
    assert {r.doc_id for r in after} == {i for i, t in before if not brute_hits(t, bench)[1]} and not any(r.source == "leak" for r in after)
    before, after = seen["bpe"]
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(pipeline.public_tokenizers.path(pipeline.TOKENIZER))
    texts = dict(before)
    for r in after:
        ids = theirs.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == b"".join(i.to_bytes(4, "little") for i in ids) and r.n_tokens == len(ids)
    assert len(after) == len(before)


def test_run_gives_the_same_rows(spark, planted):
    sf_dir = planted[0]
    out = pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and out.where(F.col("n_tokens") > 0).count() == out.count() > 100


def test_empty_documents(spark, planted):
    sf_dir = planted[0]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


CLASHES = ["x", "y", "key", "row", "res", "score", "label_id", "predicted", "kept", "mark", "nth", "node", "id", "n", "keys", "near_mark", "component_id", "part", "held_out"]


def test_extra_columns_come_back_as_they_were(spark, planted):
    """Whatever extra columns are called, and whatever they hold, each stage keeps them with their row."""
    sf_dir, rows, _, _ = planted
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [F.concat(F.lit(name + " "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name) for name in CLASHES]
    docs = docs.select("*", *extra, F.create_map(F.lit("a"), F.col("doc_id")).alias("a map"))
    for name, stage in pipeline.STAGES:
        found = pipeline.written(stage(spark, docs, sf_dir), name)
        if name == "bpe":
            break
        assert found.columns == docs.columns
        got = found.collect()
        assert got and all(r[c] == f"{c} {r.doc_id}" for r in got for c in CLASHES) and all(r["a map"] == {"a": r.doc_id} for r in got)
        docs = found


def test_odd_rows_in_every_stage(spark, planted):
    """Nulls in any column, long texts, ties and repeated rows: a text is decided alike wherever it stands."""
    sf_dir, rows, _, _ = planted
    long = sentence(random.Random(77), "en", 30_000)
    odd = [(None, rows[1][1], None, None, None), (5, long, "en", None, 1), (5, long, "en", None, 1), (6, long, "en", "a", 1), (None, None, None, None, None), (7, "", "", "", 0), (None, rows[1][1], None, None, None)]
    docs = spark.createDataFrame(rows[:200] + odd, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES[:-1]:
        before, after = Counter(tuple(r) for r in docs.collect()), Counter(tuple(r) for r in stage(spark, docs, sf_dir).collect())
        assert after and not after - before
        if name == "near_duplicates":
            texts = {r[1] for r in after}
            assert max(after.values()) == 1 and len(texts) > 100 and {r[0] for r in after if r[1] == long} == ({5} if any(r[1] == long for r in before) else set())
        else:  # repeated rows share a fate, and so do equal texts
            assert all(n == before[r] for r, n in after.items()) and {t for _, t, *_ in after}.isdisjoint({r[1] for r in before - after})


def test_near_duplicates_by_five_words_and_four_fifths(spark):
    rng = random.Random(58)
    rows = []
    for i in range(40):
        base = sentence(rng, "en", 60).split()
        edited = list(base)
        edited[20] = "edited"  # 5-word similarity 51 / 61
        rows += [(4 * i, " ".join(base)), (4 * i + 1, " ".join(base + ["added"] * (i % 16))), (4 * i + 2, " ".join(edited)), (4 * i + 3, sentence(rng, "de", 40))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = {c for _, _, c in brute_components(rows, 5, 80)}
    assert sorted(r.doc_id for r in pipeline.near_duplicates(spark, docs, None).collect()) == sorted(want)
    assert want != {c for _, _, c in brute_components(rows)}


def test_near_duplicates_keep_texts_not_ids(spark):
    rng = random.Random(59)
    a, b, *others = (sentence(rng, "en", 40) for _ in range(9))
    rows = [(3, b), (5, a), (5, b), (7, others[0]), (7, others[1]), (8, others[2]), (None, others[2]), (9, None), (None, None), (9, None)]
    rows += [(None, t) for t in (*others[3:], others[3] + " tail", others[4])]
    for mirrored in (False, True):  # whichever of the two texts sorts first
        docs = [(i, {a: b, b: a}.get(t, t) if mirrored else t) for i, t in rows]
        frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
        got = [(r.doc_id, r.text) for r in pipeline.near_duplicates(spark, frame, None).collect()]
        x, y = (b, a) if mirrored else (a, b)
        tails = {others[3], others[3] + " tail"}
        assert sum(i is None and t in tails for i, t in got) == 1
        rest = sorted(((str(i), str(t)) for i, t in got if t not in tails))
        assert rest == sorted([("3", y), ("5", x), ("7", others[0]), ("7", others[1]), ("8", others[2]), ("9", "None"), ("None", "None"), *(("None", t) for t in others[4:])])
