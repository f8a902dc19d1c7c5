"""The pipeline keeps clean documents and drops what its stages are for."""

import hashlib

import corpus_pipeline as cp
from tokenizers import Tokenizer

from millrace.llm.queries import tokenizer
from tests.llm.test_near_copies import slow_classes
from tests.llm.test_text_operators import slow_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed):
    return " ".join(hashlib.md5(f"{seed}-{i}".encode()).hexdigest()[:6] for i in range(n))


def test_stages_on_planted_rows(spark, tmp_path):
    item = "what is the distance that a train covers in one hour when it goes as fast as the other one"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, words(50, 1)), (2, words(50, 1)), (3, words(800, 3)), (4, words(400, 3) + "\n" + words(800, 3)[-2800:]), (5, "too short"), (6, None), (7, words(60, 7) + " " + item), (8, words(90, 8)), (8, words(90, 8)), (None, words(70, 9)), (None, words(70, 9)), (10, "same line here again ok now\n" * 9), (11, words(30, 11)), (12, words(9000, 12))]
    df = spark.createDataFrame([(i, t, "en", f"s{k % 3}", 0) for k, (i, t) in enumerate(rows)], SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = cp.run(spark, str(tmp_path)).collect()
    kept = [r.doc_id for r in got]
    # 4 is nearly all of 3, put together from two parts
    assert sorted(x for x in kept if x is not None) == [1, 3, 8, 11, 12] and kept.count(None) == 1
    clash = df.selectExpr("*", *[f"{k} AS {c}" for k, c in enumerate("other row own leaking t host settled carry w h of other_id component_id".split())])
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, clash, str(tmp_path))
        assert out.columns == clash.columns and out.count() > 0, name
    empty = df.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_run_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    good = {}
    for r in docs:
        c = slow_counts(r.text)
        if not (c[0] < 10 or 100 * c[4] > 20 * c[0]):
            good[r.doc_id] = r.text
    good = {i: t for (i, t), least in zip(good.items(), slow_classes(list(good.items())), strict=True) if least == i}
    leaked = {i for i, t in good.items() if any(" ".join(x.text.split()) in " ".join(t.split()) for x in items)}
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in cp.run(spark, sf).collect()}
    assert set(got) == set(good) - leaked
    for i, r in got.items():
        ids = library.encode(good[i], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
