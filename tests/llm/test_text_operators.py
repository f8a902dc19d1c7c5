"""Token counts, sharding, byte-pair encoding and quality rules on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.bpe_automaton import automaton, Automaton, bpe_decode, bpe_encode, bpe_round_trip
from millrace.llm.quality import host_verdicts, judged, passing
from millrace.llm.sharding import shard
from millrace.llm.token_counts import Encoder, encode_long, token_counts

BYTE, WORD = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LONG = " ".join(f"word{i % 97} running" for i in range(9000))
SCHEMA = "doc_id long, text string, source string, lang string, n_tokens string, w string, h string, shard string"
ROWS = [
    (1, None, "a", None, "x", "y", "z", "s"),
    (2, "", None, None, None, None, None, None),
    (3, "  \n\t ", "a", "en", "", "", "", ""),
    (4, "Hello <|endoftext|> world's 123 été", "b", "en", "", "", "", ""),
    (4, "Hello <|endoftext|> world's 123 été", "b", "en", "", "", "", ""),
    (5, LONG, "b", "en", "", "", "", ""),
    (None, "no id here, but some words all the same for the rules", "b", "en", "", "", "", ""),
    (7, "x" * 70_000, "c", "en", "", "", "", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def texts(n=400, seed=5):
    r = random.Random(seed)
    parts = ["a", "aa", "the", " ", "  ", "\n", "'s", "é", "é", "<|endoftext|>", "<|startoftext|>", "12", "!!", "\xa0", "\x1c", "　", "ö", "中", "\U0001f600", "'", "ll", "\t", "A"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(n)] + ["a" * 3000, "aA" * 900, " " * 500]


def test_automaton_gives_the_librarys_ids_and_text():
    machine, library = Automaton(BYTE), Tokenizer.from_file(BYTE)
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        assert machine.encode(t) == want
        assert machine.decode(want) == library.decode(want, skip_special_tokens=False)


def test_round_trip_digests(spark, docs):
    library = Tokenizer.from_file(BYTE)
    got = Counter(tuple(r) for r in bpe_round_trip(docs, BYTE).collect())
    want = Counter()
    for row in ROWS:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        want[row[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest()] += 1
    assert got == want
    back = bpe_decode(bpe_encode(docs, BYTE), BYTE)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((r[0], r[1] or "") for r in ROWS)
    assert bpe_round_trip(docs.limit(0), BYTE).count() == 0


def test_spliced_chunks_equal_one_encoding():
    encoder = Encoder(WORD)
    for t in [*texts(), LONG[:20_000]]:
        e = encoder.library.encode(t, add_special_tokens=False)
        whole = [(s, x, i) for (s, x), i in zip(e.offsets, e.ids, strict=True)]
        assert [i for _, _, i in encode_long(encoder, t, 150, 12)] == [i for _, _, i in whole]


def test_unbroken_text_after_words_equals_one_encoding():
    encoder = Encoder(WORD)
    for k in range(100, 180):
        t = ("running along " * 40)[:k] + " " + "x" * 500 + " and more words " * 20
        ids = encoder.library.encode(t, add_special_tokens=False).ids
        assert [i for _, _, i in encode_long(encoder, t, 150, 12)] == ids


def test_token_counts(spark, docs):
    library = Tokenizer.from_file(WORD)
    want = Counter()
    for r in ROWS:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        want[r[0], len((r[1] or "").encode()), n, n > 2048] += 1
    assert Counter(tuple(r) for r in token_counts(docs, WORD).collect()) == want
    assert token_counts(docs.limit(0), WORD).count() == 0


def test_shards_interleave_sources(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1000)]
    rows += [(1000 + i, None, None) for i in range(5)] + [(0, "text 0", "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumnRenamed("text", "body")
    got = shard(df, shards=24, text_col="body", rows_per_bucket=50).collect()
    assert len(got) == len(rows)
    by = {s: sorted(r.slot for r in got if r["shard"] == s) for s in range(24)}
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(v == list(range(len(v))) for v in by.values())
    source = {r[0]: r[2] for r in rows}
    hot = [sum(source[r.doc_id] == "hot" for r in got if r["shard"] == s) / len(by[s]) for s in range(24)]
    assert max(hot) - min(hot) < 0.08
    text = {r[0]: r[1] or "" for r in rows}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 8 and r.law == "rows" and r.grown_shard is None for r in got)
    again = shard(df.repartition(7), shards=24, text_col="body", rows_per_bucket=50).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_shards_equal_a_plain_sort(spark, docs, monkeypatch):
    import millrace.llm.sharding as sharding

    monkeypatch.setattr(sharding, "WIDE", 3)
    r = random.Random(8)
    rows = [(r.choice([None, r.randrange(400)]), r.choice([None, "", "same", f"text {i}"]), r.choice([None, "a", "a", "b", f"s{i % 5}"]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int")
    for table, per in ((df, 20), (df, 10_000), (docs, 2)):
        keyed = table.selectExpr("doc_id", "source", "coalesce(text, '') AS t", "shiftrightunsigned(xxhash64(20, doc_id, crc32(encode(coalesce(text, ''), 'utf-8'))), 32) AS mixed").collect()
        low = lambda x: (x is not None, x or 0)
        name = lambda x: (x is not None, x or "")
        order = [(x.mixed, low(x.doc_id), len(x.t.encode()) + 8, zlib.crc32(x.t.encode())) for x in keyed]
        by = {}
        for i in sorted(range(len(keyed)), key=order.__getitem__):
            by.setdefault(keyed[i].source, []).append(i)
        u = lambda s: zlib.crc32(f"20:{s or ''}".encode()) / 2**32
        ranked = sorted(((k + u(s)) / len(v), name(s), order[i], i) for s, v in by.items() for k, i in enumerate(v))
        n = len(ranked)
        want, used = Counter(), Counter()
        for pos, (_, _, o, i) in enumerate(ranked):
            number = pos * 24 // n
            want[keyed[i].doc_id, o[2], o[3], "rows", number, used[number], None] += 1
            used[number] += 1
        assert Counter(map(tuple, shard(table, shards=24, rows_per_bucket=per).collect())) == want


def test_a_long_tail_of_sources_reaches_every_shard(spark):
    """2,400 sources of one row beside one of 2,400."""
    df = spark.createDataFrame([(i, "t", "hot" if i % 2 else f"s{i}") for i in range(4800)], "doc_id long, text string, source string")
    got = Counter((r["shard"], r.doc_id % 2) for r in shard(df).collect())
    assert all(70 <= got[s, tail] <= 130 for s in range(24) for tail in (0, 1)), got


def test_shards_of_odd_tables(docs):
    assert shard(docs.limit(0)).count() == 0
    got = shard(docs).collect()
    assert len(got) == len(ROWS) and all(r.slot == 0 for r in got) and len({r["shard"] for r in got}) == len(ROWS)


def slow_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_brute_force(spark, docs):
    r = random.Random(3)
    more = [(100 + i, " ".join(r.choice("ab cd\n e#".split(" ")) for _ in range(r.randint(0, 60))), "s") for i in range(150)]
    for df, rows in ((docs, ROWS), (spark.createDataFrame(more, "doc_id long, text string, source string"), more)):
        got = Counter(tuple(x)[:7] for x in judged(df).collect())
        want = Counter()
        for row in rows:
            c = slow_counts(row[1])
            want[(row[0], *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
        assert got == want
    assert judged(docs.limit(0)).count() == 0


def test_planted_hosts_equal_the_formula(spark):
    r = random.Random(12)
    rates = {f"h{i}": (r.randint(20, 400), 0.12) for i in range(40)} | {"bad": (300, 0.45), "tiny": (3, 1.0), "third": (9000, 0.125), None: (50, 0.1)}
    rows = [(h, k < round(n * p * r.uniform(0.9, 1.1)), k % 7 == 0 and p > 0.4) for h, (n, p) in rates.items() for k in range(n)]
    got = {x.host: x for x in host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean, soft_failed boolean").repartition(4)).collect()}
    hosts = {h: (sum(x[0] == h for x in rows), sum(x[0] == h and (x[1] or x[2]) for x in rows)) for h in rates}
    big, bad, k = sum(n for n, _ in hosts.values()), sum(x for _, x in hosts.values()), len(hosts)
    p = bad / big
    spread = sum(n * (x / n - p) ** 2 for n, x in hosts.values()) / (p * (1 - p))
    corr = (spread - (k - 1)) / (big - sum(n * n for n, _ in hosts.values()) / big - (k - 1))
    strength = min(1e6, max(1.0, 1 / corr - 1)) if corr > 0 else 1e6
    for h, (n, x) in hosts.items():
        m = (x + p * strength) / (n + strength)
        low = m - 3 * (m * (1 - m) / (n + strength + 1)) ** 0.5
        assert (got[h].docs, got[h].failed) == (n, x) and got[h].lower_bound == pytest.approx(low) and got[h].host_flagged == (low > 1.5 * p)
    assert {h for h, x in got.items() if x.host_flagged} == {"bad"}


def test_other_tokenizers_are_encoded_whole(spark, docs):
    assert Encoder(WORD).splits and not Encoder(BYTE).splits
    library = Tokenizer.from_file(BYTE)
    want = Counter((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS)
    assert Counter((r.doc_id, r.n_tokens) for r in token_counts(docs, BYTE).collect()) == want


def test_host_verdicts_reach_only_failing_documents(spark):
    good, junk = "plain words that say something new each time, number {} of many", "### $$$ *** %%% &&& ||| <<< >>> # $ % word {}"
    rows = [(i, good.format(i), "clean") for i in range(50)] + [(100 + i, junk.format(i), "bad") for i in range(50)] + [(200, good.format("x"), "bad"), (201, junk.format("y"), "clean")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in judged(df).filter("kept").collect()}
    assert kept == set(range(50)) | {200, 201}
    assert {r.doc_id for r in passing(df).collect()} == kept and passing(df).columns == df.columns
    assert {r.doc_id for r in passing(df, broadcast_hosts=0).collect()} == kept
    one = spark.createDataFrame([("h", False, True)], "host string, base_failed boolean, soft_failed boolean")
    assert host_verdicts(one).collect()[0].shrunk_rate == pytest.approx(1.0)


def test_words_together_equal_words_alone():
    machine = automaton(BYTE)
    r = random.Random(4)
    words = [bytes(r.choice(b"abcdefgh ing the\xc3\xa9\x00\xff") for _ in range(r.randint(1, 200))) for _ in range(400)] + [b"the", b" the", b"x" * 64, b"x" * 65, b""]
    library = Tokenizer.from_file(BYTE)
    got = machine.encode_words(words)
    assert got == [machine.encode_word(w) for w in words]
    texts_ = [" ".join(r.choice(["unbelievable", "été", "don't", "12,5", "　", "x\n\n y"]) for _ in range(50)) for _ in range(20)]
    for t, (n, codes, decoded) in zip(texts_, machine.both(texts_), strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        assert (n, codes, decoded.decode()) == (len(ids), ",".join(map(str, ids)).encode(), t)
