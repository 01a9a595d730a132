"""Token files, periodic runs and lexical search against brute force, round trips and edge rows."""

import collections
import hashlib
import math
import random
import re
import sys
import zlib

import numpy as np
import pytest
from llm.test_llm import SCHEMA, make_docs
from pyspark.sql import functions as F

from juncture.llm import common, lexical_search, periodic_runs, queries, token_files


@pytest.fixture(scope="module")
def docs(spark):
    common.small_batches(spark)
    rows = make_docs()
    rows += [(None, "null id one two", "en", None, 0, True, 1, "x"), (None, None, None, None, 0, True, 1, "x"), (7, "shared id a", None, None, 0, True, 1, "x"), (7, "shared id b", None, None, 0, True, 1, "x")]
    odd = ["a  b   c", " lead", "trail ", "\n \n x  \t y ' s it's don't,  (foo), bar...baz \xa0 x 　y", "a\x1c b \x1cc", "<|endoftext|> is text", "日本語 テスト、です。 a", "we'll, you're. été, naïve. 12,3 x_ _y", "go " * 3000, "one two three four " * 200]
    rows += [(1000 + k, t, "en", "s1", 0, False, 2, "y") for k, t in enumerate(odd)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.byte_vocabulary())
    t.encode_special_tokens = True
    return t


# Token files


def test_ids_are_those_of_the_library(docs):
    """Texts encoded whole, in ascending doc_id, nulls last; start counts all ids before."""
    t = tokenizer()
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 0]
        want[(r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    got = token_files.encode_and_read(docs).collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1])
    keys = [(r.doc_id is None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)


def test_a_batch_is_encoded_with_its_ends():
    """Each text's ids with the end behind them, as one column, where pieces are new and where they are known."""
    import pyarrow as pa

    t, e = tokenizer(), token_files.Encoder(token_files.byte_vocabulary())
    for texts in (["the cat, the hat", None, "", "cat"], ["hat  the\tcat's", " the hat", "cat, cat. dog"], ["<|endoftext|> hat\u00e9 12 \u4e2d\u6587 dog"]):
        want = [np.array([*t.encode(x or "", add_special_tokens=False).ids, 7], "<u4").tobytes() for x in texts]
        assert e.encode(pa.array(texts, pa.string()), 7).to_pylist() == want


def test_files_are_read_back_and_in_part(spark, docs, tmp_path):
    path = f"file://{tmp_path}/ids"
    token_files.write_token_files(docs, path, partitions=5)
    t, rows = tokenizer(), docs.select("text").collect()
    assert sum(len(r.ids) for r in token_files.read_tokens(spark, path).collect()) == 4 * sum(len(t.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in rows)
    whole = b"".join(r.ids for r in token_files.read_tokens(spark, path).sort("start").collect())
    for begin, end in ((0, 1), (5, 4000), (len(whole) // 8, len(whole) // 4), (0, len(whole))):
        part = b"".join(r.ids for r in token_files.read_range(spark, path, begin, end).sort("start").collect())
        assert part == whole[4 * begin : 4 * end]


def test_empty_table_of_ids(empty):
    assert token_files.encode_and_read(empty).collect() == []


@pytest.mark.parametrize("size", [0, 1, 3, 4, 5, 2047, 2048, 2049, 8191, 8192, 8193, 50_000])
def test_blocks_round_trip(size):
    rng = np.random.default_rng(size)
    parts = [rng.zipf(1.3, n) % 40_000 for n in (size, 7, 0, size // 3)]
    ids, cuts = np.concatenate(parts).astype(np.uint32), np.cumsum([0, *map(len, parts)])
    table = token_files.Frequencies({int(i): int(n) for i, n in zip(*np.unique(ids, return_counts=True), strict=True)})
    coded = token_files.encode_documents(ids, cuts, table)
    back, where = token_files.decode_documents(coded, table)
    assert (back == ids).all() and (where == cuts).all()
    begin, end = size // 3, size // 2 + 1
    part, where = token_files.decode_documents(coded[:1], table, begin, end)
    assert (part == ids[begin : min(end, size)]).all()


def test_one_symbol_alone_and_a_broken_block():
    ids, cuts = np.zeros(9000, np.uint32), np.array([0, 9000])
    table = token_files.Frequencies({0: 9000})
    coded = token_files.encode_documents(ids, cuts, table)
    assert (token_files.decode_documents(coded, table)[0] == 0).all()
    ids = np.arange(9000, dtype=np.uint32) % 50
    table = token_files.Frequencies({i: 180 for i in range(50)})
    broken = bytearray(token_files.encode_documents(ids, cuts, table)[0])
    broken[-1] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        token_files.decode_documents([bytes(broken)], table)


@pytest.mark.parametrize("step", ["code", "decode"])
def test_documents_are_coded_together(step):
    """Heads and checkpoints of all documents are made and read at once: few calls for each further document."""
    calls = collections.Counter()
    for docs in (100, 2100):
        ids, cuts = (np.arange(5 * docs) % 40).astype(np.uint32), 5 * np.arange(docs + 1)
        table = token_files.Frequencies({i: 25 for i in range(40)})
        coded = token_files.encode_documents(ids, cuts, table)
        run = (lambda a=ids, c=cuts, t=table: token_files.encode_documents(a, c, t)) if step == "code" else (lambda c=coded, t=table: token_files.decode_documents(c, t))
        sys.setprofile(lambda frame, event, arg, n=docs: calls.update([n]) if event in ("call", "c_call") else None)
        try:
            run()
        finally:
            sys.setprofile(None)
    assert (calls[2100] - calls[100]) / 2000 < 4


def test_frames_are_not_shuffled_to_be_read(spark, docs, tmp_path):
    """A frame's start comes from a small table of parts, whatever the planner thinks of its size."""
    path = f"file://{tmp_path}/ids"
    token_files.write_token_files(docs, path, partitions=3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = token_files.summarise_files(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_marks_behind_words_and_a_worker_that_forgets():
    import pyarrow as pa

    t, text = tokenizer(), "a word, (word) word!? \u00e9t\u00e9... word,, 12.; x's, word"
    want = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes()
    for _ in range(2):
        texts = pa.array(["-", text, None]).slice(1)
        assert token_files.Encoder.of(token_files.byte_vocabulary()).encode(texts, 0).to_pylist()[0] == want
        token_files.Encoder.forget()
        assert not token_files.Encoder._known


def test_only_words_of_ascii_letters_pass_by_the_patterns(monkeypatch):
    import pyarrow as pa

    t, e, sent = tokenizer(), token_files.Encoder(token_files.byte_vocabulary()), []
    encoded = e._encoded
    monkeypatch.setattr(e, "_encoded", lambda texts, by=None: (sent.extend(texts if by is e.letters else []), encoded(texts, by))[1])
    rng = random.Random(5)
    words = ["".join(rng.choices("abcXYZ's1\u00e9\u0120_", k=rng.randint(1, 9))) for _ in range(3000)] + ["".join(rng.choices("etaoinTHE", k=rng.randint(1, 12))) for _ in range(3000)]
    rng.shuffle(words)
    text = "first " + " ".join(words)
    assert e.encode(pa.array([text]), 0).to_pylist() == [np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes()]
    past = [w for x in sent for w in x.split("\n\u0120")[1:]]
    assert len(past) > 2000 and len(past) == len(set(past)) and all(re.fullmatch("[A-Za-z]+", w) for w in past)


def test_many_rows_of_one_id_are_dealt_to_parts(spark, tmp_path):
    """A third and more of all rows share an id, or have none: no part holds them all, and the order stays."""
    rows = [(5 if k % 3 else k, f"text {k}") for k in range(600)] + [(None, f"none {k}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = f"file://{tmp_path}/ids"
    token_files.write_token_files(df, path, partitions=12)
    frames = spark.read.parquet(f"{path}/frames").select("part", F.explode("doc_ids").alias("d")).collect()
    most = collections.Counter(r.part for r in frames if r.d == 5)
    assert len(frames) == 900 and len(most) > 2 and max(most.values()) < 300
    got = token_files.summarise_files(spark, path).sort("start").collect()
    keys = [(r.doc_id is None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys) and len(got) == 900


# Periodic runs


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((a, n, q) for (a, n), q in found.items())


def periodic(rng):
    words = []
    for _ in range(rng.randrange(0, 6)):
        base = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 24, 31, 32, 33, 64, 65, 90]))]
        words += [base[k % len(base)] for k in range(int(len(base) * rng.choice([1, 2, 3.9, 4, 4.1, 5, 8])))]
        words += [b"x%d" % rng.randrange(1000) for _ in range(rng.randrange(10))]
    return words


def test_runs_against_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = [periodic(rng) for _ in range(rng.randrange(1, 10))]
        for words, runs in zip(texts, periodic_runs._searched(texts), strict=True):
            assert list(zip(*(x.tolist() for x in runs), strict=True)) == brute_runs(words)


def test_long_period_and_long_run():
    base = [b"%d" % k for k in range(5000)]
    texts = [base * 4 + [b"end"], [b"a"] * 300_000, base, []]
    got = [list(zip(*(x.tolist() for x in r), strict=True)) for r in periodic_runs._searched(texts)]
    assert got == [[(0, 20_000, 5000)], [(0, 300_000, 1)], [], []]


def test_periodic_query_against_brute_force(spark, docs, monkeypatch):
    """The whole of op12: planted repetitions, longest run, digests."""
    monkeypatch.setattr(queries, "read_documents", lambda *_: docs)
    got = collections.Counter(tuple(r) for r in queries.op12_periodic_runs(spark, "").collect())
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode())
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        gone = {i for a, m, q in runs for i in range(a + q, a + m)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        want[
            (r.doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], digest("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()),
             digest(b" ".join(w for i, w in enumerate(words) if i not in gone)))
        ] += 1
    assert got == want


def test_runs_of_an_empty_table(empty):
    assert periodic_runs.summarise_runs(periodic_runs.periodic_runs(empty)).collect() == []


# Lexical search


def brute_search(docs, items, k=50):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    texts = [(d, collections.Counter(cut(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in texts]
    N, L = sum(n > 0 for n in sizes), sum(sizes)
    df = collections.Counter(t for _, c in texts for t in c)
    out = []
    for item, text in items:
        scored = []
        for (d, c), n in zip(texts, sizes, strict=True):
            m = 50 + (50 * n * N) // L if L else 0
            score = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in {*cut(text)} if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out)


def items_of(rows):
    texts = [t for _, t in rows if t]
    return [(1, texts[0]), (2, "ONE two, three"), (3, None), (4, "!!"), (5, "nothing here zzzz"), (6, " ".join(texts[:8])[:4000]), (7, "same same"), (8, "été 日本語 テスト、です")]


def test_search_against_brute_force(spark, docs, monkeypatch):
    """Small segments and tasks, so that thresholds are carried; ties, repeated rows, null ids."""
    monkeypatch.setattr(lexical_search, "SEGMENT_ROWS", 16)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame(items_of(rows), "item_id long, text string")
    for k in (1, 3, 50):
        got = sorted(tuple(r) for r in lexical_search.search(df, items, k).collect())
        assert got == brute_search(rows, items_of(rows), k)


def test_search_in_blocks(spark, docs, monkeypatch):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    items = spark.createDataFrame(items_of(rows), "item_id long, text string")
    want = sorted(tuple(r) for r in lexical_search.search(docs, items, 5).collect())
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 3)
    assert sorted(tuple(r) for r in lexical_search.search(docs, items, 5).collect()) == want


def test_accumulators_stop_and_stay_exact():
    """With bounds that let creation stop early, what stays is scored whole."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        n, k = 300, int(rng.integers(1, 20))
        postings = []
        for size in sorted(rng.integers(1, n, 8)):
            docs = np.sort(rng.choice(n, size, replace=False))
            postings.append((docs, rng.integers(1, 1 + 100_000 // (size * size), size)))
        whole = np.zeros(n, np.int64)
        for docs, parts in postings:
            whole[docs] += parts
        found, scores = lexical_search.accumulate(postings, [int(p.max()) for _, p in postings], n, 0, k)
        assert (whole[found] == scores).all()
        best = lambda ids, values: sorted(zip((-values).tolist(), ids.tolist(), strict=True))[:k]
        there = np.flatnonzero(whole)
        assert best(found, scores) == best(there, whole[there])


def test_search_without_documents_or_items(spark, docs, empty):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical_search.search(empty, items).collect() == []
    assert lexical_search.search(docs, items.filter("item_id = 0")).collect() == []


# Faults of earlier operators that were mended


def test_near_copies_with_shared_and_missing_ids(spark):
    """Unlike rows that share an id both stay; near copies without ids leave one."""
    from juncture.llm import ngram_join

    text = lambda tag: " ".join(f"{tag}{k}" for k in range(60))
    rows = [(1, text("a")), (2, text("a") + " more"), (2, text("b")), (3, text("c")), (None, text("d")), (None, text("d") + " x"), (None, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = collections.Counter(tuple(r) for r in ngram_join.keep_one_of_each(df).collect())
    lone = collections.Counter([(1, text("a")), (2, text("b")), (3, text("c")), (None, None), (4, "")])
    assert kept - lone in (collections.Counter([(None, text("d"))]), collections.Counter([(None, text("d") + " x")])) and not lone - kept


def test_a_long_text_leaves_no_language_without_a_model(spark, monkeypatch):
    from juncture.llm import language_id

    rows = [(k, "aa ab ac " * 400, "aa") for k in range(8)] + [(100 + k, "zy zx zw " * 10, "zz") for k in range(8)] + [(5, "aa ab", "aa")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_id._sample(df, 600, "train", 1000).collect()
    size = collections.Counter()
    for r in sample:
        size[r.lang] += len(r.text)
    assert size["aa"] == 1000 and size["zz"] == 8 * 90
    assert max(collections.Counter(r.lang for r in language_id._sample(df, 5, "train").collect()).values()) <= 5
    assert language_id.train(df, F.lit(False)).names == ["aa", "zz"]


PAGES = [
    ("<html><head><title>t</title><p>one</p><img src=a.png>", [("text", "one", None, None), ("image", None, "a.png", None)]),
    ("<head><meta x>plain text", [("text", "plain text", None, None)]),
    ("<figure><img src=a><figcaption>cap</figure><p>rest</p>", [("image", None, "a", "cap"), ("text", "rest", None, None)]),
    ("<figure><img src=a><figcaption>cap", [("image", None, "a", "cap")]),
    ("<figure><figure><img src=in><figcaption>inner</figcaption></figure><img src=out><figcaption>outer</figcaption></figure>", [("image", None, "in", "inner"), ("image", None, "out", "outer")]),
    ("<img data-src=lazy alt=x><img srcset='s1 1x, s2 2x'><iframe src=f></iframe>", [("image", None, "lazy", "x"), ("image", None, "s1", None), ("iframe", None, "f", None)]),
    ("<script>no<b></script>yes<style>no", [("text", "yes", None, None)]),
    ("<p>a<p>b<ul><li>c<li>d</ul>", [("text", t, None, None) for t in "abcd"]),
    ("", []),
    (None, []),
    ("<noscript><img src=n></noscript><title>x</title>after", [("text", "after", None, None)]),
]


@pytest.mark.parametrize(("page", "want"), PAGES)
def test_pages_with_missing_end_tags(page, want):
    from juncture.llm import media

    got = media.parse_segments(page)
    assert [(s["kind"], s["text"], s["ref"], s["caption"]) for s in got] == want
    assert [s["position"] for s in got] == list(range(len(got)))


def test_payloads_inside_a_page():
    from juncture.llm import media

    got = media.parse_segments("<img src='data:image/gif;base64,aGVsbG8='><img src='data:,a%20b'><img src='sha256:AB'>")
    assert [s["digest"] for s in got] == [hashlib.sha256(b"hello").hexdigest(), hashlib.sha256(b"a b").hexdigest(), "ab"]


def test_rows_without_ids_are_spread(spark):
    """A third of all rows has no id: they are drawn and numbered in many blocks, and each keeps its row."""
    from juncture.llm import mixing, sharding

    rows = [(None if k % 3 == 0 else k, " ".join(["w"] * (1 + k % 7)), "abc"[k % 3 + (k % 9 == 0)]) if k % 9 else (5, "x y", None) for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_documents(df).collect()
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((d, len(t.split())) for d, t, _ in rows)
    assert all(r.taken <= 3 * r.size for r in got)
    placed = df.select("doc_id", F.monotonically_increasing_id().alias("n"), F.lit(0).alias("shard"))
    slots = sharding.number_slots(placed, "doc_id", 900, 1, slot_rows=100).collect()
    assert sorted(r.slot for r in slots) == list(range(900))
