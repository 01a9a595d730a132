"""The llm operators against brute force, round trips and edge rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from juncture.llm import common, exact_dedup, language_id, media, mixing, ngram_join, passage_dedup, secrets, sentencepiece, sharding, suffix_dedup
from juncture.llm.components import connected_components, grow_components

WORDS = [f"{a}{b}" for a in ("ba", "de", "ki", "lo", "mu", "ra", "ti", "zo") for b in ("n", "rt", "ss", "la", "ven", "qua")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, component_id long, shard string"
RAW = re.compile(rb"[^\x20\x09-\x0D]+")


def words(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def make_docs(seed=0):
    """Copies, near copies, shared passages, repeats within, long, short, empty and null texts; clashing columns."""
    rng = random.Random(seed)
    texts = [None, "", "   ", "one", "one two", "ONE  two", "one\ttwo", "a" * 700, "ab" * 200, "xé\U0001f600 y", "\0\0", "same same same same same", None, ""]
    base = words(rng, 150)
    texts += [" ".join(base), " ".join(base), "\n".join([" ".join(base[:70]), " ".join(base[70:])])]
    for k in range(12):
        w = list(base)
        for _ in range(k):
            w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
        texts.append(" ".join(w))
    passage = words(rng, 60)
    for _ in range(5):
        texts.append(" ".join(words(rng, rng.randrange(5, 80)) + passage + words(rng, rng.randrange(5, 80))))
    texts += [" ".join(words(rng, rng.randrange(1, 200))) for _ in range(40)]
    texts.append(" ".join(words(rng, 9000)))
    rng.shuffle(texts)
    return [(k * 3, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", None]), 0, True, 7, "x") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    common.small_batches(spark)
    return spark.createDataFrame(make_docs(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def text_rows(docs):
    return sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())


def test_media_round_trip(docs, empty):
    got = {r.doc_id: r for r in media.documents_as_media(docs).collect()}
    for key, text in text_rows(docs):
        raw = text.encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        r = got[key]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        png = media.to_png(payload)
        assert (r.media_bytes, r.media_sha256) == (len(png), hashlib.sha256(png).hexdigest()) and media.from_png(png) == payload
        assert r.caption == f"{len(raw)} bytes"
    assert media.documents_as_media(empty).count() == 0


def test_interleaved_pages(spark):
    page = '<head><title>t</title></head><p>one &amp; <b>two</b><figure><img src="sha256:AB" alt="x"><figcaption>cap</figcaption></figure>tail<img src="http://u/i.png" alt="alt"><script>var a="<p>";</script>'
    rows = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<p>unclosed <i>x")], "page_id int, html string")
    seq = {r.page_id: [(s.position, s.kind, s.text, s.digest, s.caption) for s in r.segments] for r in media.interleave(rows, "page_id", "html").collect()}
    assert seq[1] == [(0, "text", "one & two", None, None), (1, "image", None, "ab", "cap"), (2, "text", "tail", None, None), (3, "image", None, None, "alt")]
    assert seq[2] == seq[3] == [] and seq[4][0][2] == "unclosed x"
    table = spark.createDataFrame([("ab", 5)], "digest string, size int")
    got = {r.position: r.size for r in media.resolve(media.interleave(rows, "page_id", "html"), "page_id", table).filter("page_id = 1").collect()}
    assert got == {0: None, 1: 5, 2: None, 3: None}


def brute_components(rows, n, num, den):
    sets, up = {}, {}
    for key, text in rows:
        w = [x.lower() if x.isascii() else x for x in RAW.findall(text.encode())]
        sets[key] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        up[key] = key

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common_n = len(sets[a] & sets[b])
            if common_n and den * common_n >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


@pytest.mark.parametrize(("n", "num", "den"), [(3, 90, 100), (5, 8, 10), (2, 5, 10), (1, 7, 10)])
def test_ngram_join(docs, empty, n, num, den):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, n, num, den).collect()}
    assert got == brute_components(text_rows(docs), n, num, den)
    assert ngram_join.jaccard_components(empty, n, num, den).count() == 0


def test_ngram_join_in_tiles(docs):
    """Runs of more than two classes are cut into tiles; the links are the same."""
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, 2, 5, 10, tile=2).collect()}
    assert got == brute_components(text_rows(docs), 2, 5, 10)


def test_near_copies_keep_one(docs):
    kept = ngram_join.keep_one_of_each(docs)
    want = {k for k, (_, c) in brute_components(text_rows(docs), 5, 8, 10).items() if k == c}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1001 + k) for k in range(50)] + [(5, 5), (3000, 2000)]
    rng.shuffle(edges)
    rows = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges] + [(None, 4), (4, None)], "a long, b long")
    groups = collections.defaultdict(set)
    for r in connected_components(rows).collect():
        groups[r.root].add(r.node)
    assert sorted(map(len, groups.values())) == [2, 51, 61]
    assert connected_components(rows.filter("a < 0")).count() == 0


def test_components_grow(spark):
    """Components and further links are those of all links together; new nodes, self links, nulls and empty tables."""
    rng = random.Random(3)
    first, more = ([(rng.randrange(200), rng.randrange(200)) for _ in range(n)] for n in (60, 80))

    def table(rows):
        return spark.createDataFrame(rows, "a long, b long")

    def groups(df):
        found = collections.defaultdict(set)
        rows = df.collect()
        for r in rows:
            found[r.root].add(r.node)
        assert len({r.node for r in rows}) == len(rows)
        return sorted(map(sorted, found.values()))

    old = connected_components(table(first))
    assert groups(grow_components(old, table([*more, (7, 7), (None, 1), (1, None)]))) == groups(connected_components(table(first + more)))
    assert groups(grow_components(old, table([]))) == groups(old)
    assert groups(grow_components(connected_components(table([])), table(more))) == groups(connected_components(table(more)))


def test_segmentations(docs, empty):
    vocabulary = sentencepiece.Vocabulary.load()
    rows = sentencepiece.sample_segmentations(docs.select("doc_id", "text", "kept"), 3).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for key, text in text_rows(docs):
        own = sorted(by[key], key=lambda r: r.sample)
        assert own and len({tuple(r.ids) for r in own}) == len(own)
        assert [r.perturbed for r in own] == sorted((r.perturbed for r in own), reverse=True)
        for r in own:
            assert r.round_trip and sentencepiece.decode(vocabulary, r.ids) == text and r.log_inclusion <= 0 and r.n_pieces == len(r.ids)
    again = {(r.doc_id, r.sample): tuple(r.ids) for r in sentencepiece.sample_segmentations(docs.repartition(5), 3).collect()}
    assert again == {(r.doc_id, r.sample): tuple(r.ids) for r in rows}
    assert sentencepiece.sample_segmentations(empty).count() == 0


def test_segmentation_frequencies():
    """First samples follow the lattice's probabilities, and no sample repeats."""
    vocabulary, n = sentencepiece.Vocabulary.load(), 3000
    scores, ids, ends = sentencepiece.sample_texts(vocabulary, ["the cat"] * n, list(range(n)), 2)
    first, chance, at = collections.Counter(), {}, 0
    for rows in scores:
        got = []
        for log, *_ in rows:
            path = tuple(ids[ends[at] : ends[at + 1]].tolist())
            chance[path] = np.exp(log)
            got.append(path)
            at += 1
        assert len(set(got)) == len(got)
        first[got[0]] += 1
    assert abs(sum(chance.values()) - 1) < 0.01
    for path, p in chance.items():
        assert abs(first[path] / n - p) < 4 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_long_stretch_without_boundary():
    """220 characters without a space: probabilities and boundary frequencies against sums over all segmentations."""
    vocabulary, n = sentencepiece.Vocabulary.load(), 1500
    rng = random.Random(17)
    text = "".join(rng.choice(["the", "ing", "QZ", "re", "x", "tion", "7"]) for _ in range(300))[:220]
    body = sentencepiece.SPACE + text
    weight = {p: w for p, w in zip(vocabulary.pieces, vocabulary.weights.tolist(), strict=True) if w}
    spans = [(i, j, weight[body[i:j]]) for i in range(len(body)) for j in range(i + 1, min(i + 17, len(body) + 1)) if body[i:j] in weight]
    # A factor of 1,000 a character keeps the sums within range; it cancels, as all paths have the same length.
    ahead, behind = [1.0] + [0.0] * len(body), [0.0] * len(body) + [1.0]
    for i, j, w in spans:
        ahead[j] += w * 1e3 ** (j - i) * ahead[i]
    for i, j, w in reversed(spans):
        behind[i] += w * 1e3 ** (j - i) * behind[j]
    share = [a * b / ahead[-1] for a, b in zip(ahead, behind, strict=True)]
    scores, ids, ends = sentencepiece.sample_texts(vocabulary, [text] * n, list(range(n)), 1)
    seen = np.zeros(len(body) + 1)
    for k, rows in enumerate(scores):
        pieces = [vocabulary.pieces[i] for i in ids[ends[k] : ends[k + 1]]]
        assert "".join(pieces) == body
        log = sum(np.log(weight[p] * 1e3 ** len(p)) for p in pieces) - np.log(ahead[-1])
        assert abs(rows[0][0] - log) < 1e-6
        seen[np.cumsum([0, *map(len, pieces)])] += 1
    for got, p in zip(seen / n, share, strict=True):
        assert abs(got - p) < 4.5 * (p * max(0, 1 - p) / n) ** 0.5 + 1e-3


def test_very_long_stretch():
    """100,000 characters without a boundary keep their sums within range and decode again."""
    vocabulary, rng = sentencepiece.Vocabulary.load(), random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzQZ0") for _ in range(100_000))
    scores, ids, ends = sentencepiece.sample_texts(vocabulary, [text, None, "é\u4e00 x"], [1, 2, 3], 2)
    assert len(scores[0]) == 2 and np.isfinite([x[0] for x in scores[0]]).all()
    assert all(sentencepiece.round_trips(vocabulary, [text, None, "é\u4e00 x"], [d for d, got in enumerate(scores) for _ in got], ids, ends))
    assert all(sentencepiece.decode(vocabulary, ids[ends[k] : ends[k + 1]]) == text for k in range(2))


KEY = 'AKIA' + "ABCDEFGH12345678"
SECRETS = [
    None, "", "nothing here", f"x {KEY} y {KEY[:19]} z", "Password = 'abc123' token:abc secret:token:abcdefgh", "api_key=\"A1b2C3d4\" APIKEY : zzzzzz passwd==abcdef", "deadbeef" * 3 + " " + "deadbeef" * 2,
    "\U0001f600é token=abcdef1 " * 3, "q9Xv2LmN8pRt4WzK7yBc3JdF " + "abcdefghijklmnopqrstuvwxyz" + " 8f14e45f-ceea-467f-9575-5f1e3c2a1b0d", "token=" + "a" * 5000, "A1b2" * 40, "3f9a" * 12 + "1c7e2b9d04f6a8c5",
    "src/main/module_12/Readme/2024/part-7a/x", "QX7ZK2M9R4TP0VWA5JHN", "q7zk2m9r4tp0vwa5jhnb", "user_profile_settings_page_2_of_12/and-more", "=" * 50 + "1a+", " ".join(f"token=v{k:06d}" for k in range(300)),
]


def brute_secrets(text):
    spans = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 6:
            spans.append((m.start(), 1, "assign", m.end()))
    spans += [(m.start(), 2, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 3, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    base = list(spans)
    for m in re.finditer(secrets.CANDIDATE, text):
        plain = f"[/_=-]*({secrets.WORDS})([/_=-]+({secrets.WORDS}))*[/_=-]*"
        if any(re.search(p, m[0]) for p in secrets.ALLOWED) or re.fullmatch(plain, m[0]):
            continue
        limit = secrets.gain_limit(next(bits for _, p, bits in secrets.CLASSES if re.search(p, m[0])))
        hits = [i for i in range(len(m[0]) - secrets.WINDOW + 1) if sum(secrets.GAIN[c] for c in collections.Counter(m[0][i : i + secrets.WINDOW]).values()) <= limit]
        if hits:
            spans.append((m.start() + hits[0], 4, "entropy", m.start() + hits[-1] + secrets.WINDOW))
    show = lambda x: ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(x))
    counts = collections.Counter(s[2] for s in spans)
    return tuple(counts[k] for k in ("assign", "access", "hex", "entropy")), hashlib.sha256(show(base).encode()).hexdigest(), show(spans)


def test_secrets(spark, docs, empty):
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(SECRETS)], "doc_id long, text string, spans string")
    for r in secrets.scan_secrets(rows).collect():
        assert ((r.n_assign, r.n_access, r.n_hex, r.n_entropy), r.base_sha256, r.spans) == brute_secrets(SECRETS[r.doc_id] or ""), SECRETS[r.doc_id]
    assert secrets.scan_secrets(docs).count() == docs.count() and secrets.scan_secrets(empty).count() == 0
    plan = secrets.scan_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_secrets_of_long_texts(spark):
    """A candidate of 200,000 characters, 20,000 matches and runs that tempt a regular expression to go back."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("QX7ZK2M9R4TP0VWA5JHNabcdefghij/") for _ in range(200_000)), " ".join(f"token=v{k:06d}" for k in range(20_000)), "/".join(["ab", "CD", "Efg", "123"] * 20_000), "-" * 100_000 + "1a+", "token" + " " * 100_000 + "x"]
    for r in secrets.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        assert ((r.n_assign, r.n_access, r.n_hex, r.n_entropy), r.base_sha256, r.spans) == brute_secrets(texts[r.doc_id])


def test_mixing(spark, docs, empty):
    rng = random.Random(8)
    rows = [(k, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a", "b", "c", "d", None])) for k in range(3000)] + [(9000, None, "e"), (9001, "w w w", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df).collect()
    again = {r.doc_id: r.taken for r in mixing.mix_sources(df.repartition(7)).collect()}
    assert len(got) == len(rows) and again == {r.doc_id: r.taken for r in got}
    size, of = collections.Counter(), {k: s for k, _, s in rows}
    for k, t, s in rows:
        size[s] += len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(size.values()), set()
    while True:
        level = (total - sum(3 * size[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and level * weight[s] > 3 * size[s]}
        if not more:
            break
        capped |= more
    want = {s: 3 * size[s] if s in capped else level * weight[s] for s in order}
    taken = collections.Counter()
    for r in got:
        s = of[r.doc_id]
        assert r.source_size == size[s] and abs(r.target - want[s]) < 1e-6 and r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - want[s]) <= max(3, 0.01 * want[s])
    assert mixing.mix_sources(docs).count() == docs.count() and mixing.mix_sources(empty).count() == 0
    repeated = collections.Counter(r.doc_id for r in mixing.mixed_rows(df).collect())
    assert all(repeated[r.doc_id] == r.copies for r in got)


CLASHING = ["copies", "_id", "_copy", "_key", "_own", "_turn", "_copies", "_digest", "_maybe", "_kept", "_whole", "_gone_id", "again", "Key", "base"]


def clashing(spark, rows):
    """Rows of (doc_id, text, source) with a column for every name that the operators might use themselves."""
    return spark.createDataFrame([(*r, *[7] * len(CLASHING)) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in CLASHING))


def test_stages_with_clashing_columns_repeated_and_null_ids(spark):
    df = clashing(spark, [(1, "w " * 50, "a"), (1, "w " * 50, "a"), (2, "v " * 50, "b"), (None, "u " * 50, "b"), (None, None, None), (3, "w  " * 50, "a")])
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns and mixed.filter("copies <> 7").count() == 0
    most = collections.Counter((r.doc_id, r.text) for r in mixed.collect())
    assert most[(1, "w " * 50)] <= 6 and all(n <= 3 for k, n in most.items() if k[0] != 1) and most[(None, "u " * 50)] > 0
    alone = exact_dedup.drop_duplicates(df)
    assert alone.columns == df.columns and sorted(str(r.doc_id) for r in alone.collect()) == ["1", "2", "None", "None"]
    rest = exact_dedup.without_ids(df, df.filter("doc_id = 1"))
    assert rest.columns == df.columns and sorted(str(r.doc_id) for r in rest.collect()) == ["2", "3", "None", "None"]
    kept = ngram_join.keep_one_of_each(df)
    # Rows that share an id are compared by their texts like any others, so of equal ones one stays.
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None", "None"]
    assert suffix_dedup.remove_repeats(df).count() == sharding.shard_documents(df).count() == secrets.scan_secrets(df).count() == 6
    assert mixing.mix_sources(df).count() == exact_dedup.exact_duplicates(df).count() == 6


def test_cube_flight_keeps_totals():
    rng = random.Random(1)
    size = np.array([rng.randrange(1, 500) for _ in range(400)])
    pi = np.full(400, 0.37)
    out = mixing.cube_flight(size, pi, 5, land=False)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out @ size - pi @ size) < 1e-6 * size.sum() and abs(out.sum() - pi.sum()) < 1e-6
    share = np.mean([mixing.cube_flight(size[:40], pi[:40], s, land=False) for s in range(2000)], axis=0)
    assert np.abs(share - 0.37).max() < 0.06


def test_blocks_and_rounds(spark):
    rows = spark.range(2000).select(F.col("id").alias("key"), F.lit("s").alias("stratum"), (F.col("id") % 50 + 1).alias("size"), F.lit(0.4).alias("pi"))
    got = mixing.cube_sample(rows, "stratum", block_rows=100).collect()
    assert len(got) == 2000 and {r.pi for r in got} == {0.0, 1.0}
    assert abs(sum(r.size * r.pi for r in got) - 0.4 * sum(r.size for r in got)) <= 60


def test_language_id(spark, empty):
    rng = random.Random(3)
    letters = {"xx": "abcdefgh ", "yy": "hijklmno ", "zz": "opqrstua "}
    rows = [(k, "".join(rng.choice(letters[lang]) for _ in range(rng.randrange(30, 300))), lang) for k in range(400) for lang in [rng.choice(list(letters))]]
    rows += [(900, None, "xx"), (901, "123 !!", "xx"), (902, "", None), (903, "abc " * 400_000, "xx"), (904, "日本語" * 50, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify_documents(df).collect()}
    truth = {k: lang for k, _, lang in rows}
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert {k for k in truth if got[k].held_out} == {k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(got[k].lang_pred == truth[k] for k in held) / len(held) > 0.97
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (900, 901, 902))
    assert got[903].lang_pred == "xx" and not got[904].accepted and all(0 <= r.score <= 1 for r in got.values())
    hidden = {r.doc_id: r.lang_pred for r in language_id.identify_documents(df.withColumn("lang", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0, F.col("lang")))).collect()}
    assert hidden == {k: r.lang_pred for k, r in got.items()}
    kept = {r.doc_id for r in language_id.keep_accepted(df).collect()}
    assert set(range(400)) <= kept and not kept & {900, 901, 902, 904}
    assert language_id.identify_documents(empty).count() == 0
    nothing = language_id.identify_documents(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).first()
    assert nothing.lang_pred == "und"


def test_odd_calibration_row_lifts_no_limit(spark):
    rng = random.Random(4)
    letters = {"xx": "abcdefgh ", "yy": "hijklmno "}
    rows = [(k, "".join(rng.choice(letters[lang]) for _ in range(rng.choice([12, 40, 300]))), lang) for k in range(400) for lang in [rng.choice(list(letters))]]
    junk = [k for k in range(1000, 1100) if zlib.crc32(str(k).encode()) % 5 == 1][:2]
    rows += [(k, "qwrtzuip" * 40, "xx") for k in junk] + [(2000, "vwxyzqrst" * 40, None)]
    kept = {r.doc_id for r in language_id.keep_accepted(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == set(range(400))


def test_kneser_ney_sums_to_one(spark):
    df = spark.createDataFrame([(k, "abab abba baab " * 5, "q") for k in range(20)], "doc_id long, text string, lang string")
    models = language_id.train(df, F.col("doc_id") == 3)
    model = models.models[0]
    context = language_id.gram_hashes(" ab")
    total = 0.0
    for letter in "ab ":
        grams = [g[-1:] for g in language_id.gram_hashes(" ab" + letter)]
        total += float(np.exp(model.log_probability(grams, [None, *[c[-1:] for c in context[:-1]]]))[0])
    assert abs(total + model_rest(model, context) - 1) < 1e-6


def model_rest(model, context):
    """Probability of a character never seen after the context."""
    p = np.full(1, model.floor)
    for k in range(language_id.ORDER):
        mass = model.contexts[0][1][:1] if k == 0 else model._find(model.contexts[k], context[k - 1][-1:], 1.0)
        p = mass * p
    return float(p[0])


def brute_cross_entropy(train, text, vocabulary):
    """Nats a character of an interpolated Kneser-Ney model of order 4, from dictionaries of strings; vocabulary: how
    many characters any language has."""
    order, pad = language_id.ORDER, " " * (language_id.ORDER - 1)
    seen = {n: collections.Counter() for n in range(1, order + 1)}
    for t in train:
        t = pad + t
        for i in range(len(pad), len(t)):
            for n in seen:
                seen[n][t[i - n + 1 : i + 1]] += 1
    used = {order: dict(seen[order])}
    for n in range(1, order):
        before = collections.Counter(g[1:] for g in seen[n + 1])
        used[n] = {g: before.get(g, 1) for g in seen[n]}
    tables = []
    for n in range(1, order + 1):
        n1, n2 = (sum(c == k for c in used[n].values()) for k in (1, 2))
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        total, kinds = collections.Counter(), collections.Counter()
        for g, c in used[n].items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        tables.append((used[n], total, kinds, d, min(d, min(used[n].values()))))
    log, t = 0.0, pad + text
    for i in range(len(pad), len(t)):
        p = 1.0 / (vocabulary + 1)
        for n, (c, total, kinds, d, back) in enumerate(tables, 1):
            g = t[i - n + 1 : i + 1]
            if total[g[:-1]]:
                p = max(c.get(g, 0) - d, 0) / total[g[:-1]] + back * kinds[g[:-1]] / total[g[:-1]] * p
        log += np.log(p)
    return -log / len(text)


def test_kneser_ney_against_brute_force(spark):
    rng = random.Random(14)
    letters = {"xx": "abcde fg", "yy": "efg hijk"}
    texts = {lang: [" ".join("".join(rng.choice(chars) for _ in range(20)).split()) for _ in range(12)] for lang, chars in letters.items()}
    rows = [(k, t, lang) for lang, own in texts.items() for k, t in enumerate(own, 100 if lang == "yy" else 0)]
    models = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(False))
    assert models.names == ["xx", "yy"]
    vocabulary = len({c for own in texts.values() for t in own for c in language_id.normalise(t)})
    for probe in ("abc fed", "hijk gfe e", "zzz", "a"):
        body = language_id.normalise(probe)
        want = [brute_cross_entropy([language_id.normalise(t) for t in texts[lang]], body, vocabulary) for lang in models.names]
        assert np.allclose(models.cross_entropies(body), want, atol=1e-5)


def test_exact_dedup(docs, empty):
    groups = collections.defaultdict(list)
    for key, text in text_rows(docs):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text)].append(key)
    want = {k: (min(g), len(g), k == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for k in g}
    for bits in (exact_dedup.MAX_BITS, exact_dedup.SEGMENT_BITS):
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_duplicates(docs, bits).collect()}
        assert got == want
    kept = exact_dedup.drop_duplicates(docs)
    assert {r.doc_id for r in kept.collect()} == {k for k, v in want.items() if v[2]} and kept.columns == docs.columns
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_repeated_rows_keep_one(spark):
    rows = spark.createDataFrame([(1, "a  b"), (1, "a b"), (2, "a b"), (None, "a b"), (None, "q")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(rows).collect() if r.doc_id)
    assert got == [(False, 1, 1, 4, False), (False, 1, 1, 4, True), (False, 2, 1, 4, False)]


def test_stage_keeps_a_row_of_repeated_and_null_ids(spark):
    rows = [(1, "a b"), (1, "a  b"), (1, "other"), (2, "a b"), (3, "c"), (3, "c"), (4, "d"), (None, "e"), (None, "e"), (None, "a b"), (5, None), (6, "")]
    got = exact_dedup.drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter((r.doc_id, " ".join((r.text or "").split())) for r in got) == collections.Counter([(1, "a b"), (1, "other"), (3, "c"), (4, "d"), (None, "e"), (5, "")])


def test_filters_by_range(spark):
    """Rows that need more bits than one filter may have: the same groups, and still few rows flagged."""
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_duplicates(rows, exact_dedup.SEGMENT_BITS)
    assert got.count() == 30_000 and got.filter("not kept").count() == 299 and got.filter("kept").agg(F.max("group_size")).first()[0] == 300
    hashes = rows.select(F.unhex(F.sha2("text", 256)).alias("digest"))
    assert 300 <= exact_dedup.flag_repeated(hashes, 30_000, exact_dedup.SEGMENT_BITS).filter("again").count() < 2000


def test_sections_take_a_fixed_number_of_jobs(spark):
    """As many jobs for 1,024 sections as for 4; every repeated digest is flagged, nearly no other one; rows of chunks
    keep their other columns."""
    hashes = spark.range(60_000).select(F.col("id").alias("_chunk"), F.unhex(F.sha2(F.when(F.col("id") % 3 == 0, "same").otherwise((F.col("id") % 50_000).cast("string")), 256)).alias("digest"))
    times = collections.Counter(bytes(r.digest) for r in hashes.collect())
    jobs = []
    for bits in (1 << 18, 1 << 10):
        spark.sparkContext.setJobGroup(f"sections{bits}", "")
        got = exact_dedup._flag_by_sections(hashes, 60_000, bits).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"sections{bits}")))
        assert sorted(r._chunk for r in got) == list(range(60_000))
        assert all(r.again for r in got if times[bytes(r.digest)] > 1)
        assert sum(r.again for r in got if times[bytes(r.digest)] == 1) < 600
    spark.sparkContext.setJobGroup("", "")
    assert jobs[0] == jobs[1] and not [t for t in spark.catalog.listTables() if t.name.startswith("juncture_")]


def test_saturated_filter_changes_nothing(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2000).cast("string").alias("text"))
    hashes = rows.select(F.unhex(F.sha2("text", 256)).alias("digest"))
    full = b"\xff" * (exact_dedup.SEGMENT_BITS // 8)
    assert exact_dedup.maybe_repeated(hashes, "digest", full, "m").filter("m").count() == 3000
    real = exact_dedup.repeated_filter(hashes, "digest", exact_dedup.SEGMENT_BITS)
    flagged = exact_dedup.maybe_repeated(hashes, "digest", real, "m").filter("m").count()
    assert 2000 <= flagged < 2200


def test_passages(docs, empty):
    rows = passage_dedup.repeated_passages(docs).collect()
    removed = collections.defaultdict(set)
    for r in rows:
        if r.removed:
            removed[r.doc_id] |= set(range(r.start, r.start + r.words))
    seen, caught = {}, 0
    for key, text in text_rows(docs):
        w = [x.lower() for x in RAW.findall(text.encode())]
        again = [i for i in range(len(w) - 50) if tuple(w[i : i + 51]) in seen]
        for i in range(len(w) - 50):
            seen.setdefault(tuple(w[i : i + 51]), key)
        if again:
            caught += 1
            assert removed[key] & set(range(again[0], again[-1] + 51))
    assert caught >= 5
    unique = [k for k, t in text_rows(docs) if len(RAW.findall(t.encode())) == 9000]
    assert not any(removed[k] for k in unique)
    assert passage_dedup.repeated_passages(empty).count() == 0


def test_passages_stood_before_as_a_whole(spark):
    """A chain of phrases, each two of which stood side by side before, 18 words together, holds no passage of 20."""
    chain = [[f"w{k}x{i}" for i in range(9)] for k in range(100)]
    texts = [[f"a{k}", *chain[k], *chain[k + 1], f"z{k}"] for k in range(99)] + [[w for phrase in chain for w in phrase]]
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    assert passage_dedup.repeated_passages(rows).filter("kind = 'passage'").count() == 0


def windows_seen(texts):
    """By document, the words in any 20-word window that stood before, by brute force."""
    seen, out = set(), {}
    for key, text in texts:
        w = [x.lower() for x in RAW.findall(text.encode())]
        out[key] = set()
        for i in range(len(w) - 19):
            if tuple(w[i : i + 20]) in seen:
                out[key] |= set(range(i, i + 20))
            seen.add(tuple(w[i : i + 20]))
    return out


def test_passages_have_exact_edges(spark, docs):
    """Passages of 20 to 50 words, lines wrapped at will, and the fixture, against brute force."""
    rng = random.Random(12)
    texts = [(k, " ".join(words(rng, 300))) for k in range(20)]
    for n in range(20, 51):
        w = texts[rng.randrange(20)][1].split()
        at = rng.randrange(300 - n)
        inside = " ".join(w[at : at + n]).replace(" ", "\n", rng.randrange(4))
        texts.append((100 + n, " ".join([*words(rng, rng.randrange(30)), inside, *words(rng, rng.randrange(30))])))
    for rows, df in ((texts, spark.createDataFrame(texts, "doc_id long, text string").repartition(5)), (text_rows(docs), docs)):
        flat = {k: [x.lower() for x in RAW.findall(t.encode())] for k, t in rows}
        joined = {k: b" " + b" ".join(w) + b" " for k, w in flat.items()}
        got = collections.defaultdict(set)
        for r in passage_dedup.repeated_passages(df).filter("kind = 'passage'").collect():
            got[r.doc_id] |= set(range(r.start, r.start + r.words))
            assert r.words >= 20 and b" " + b" ".join(flat[r.doc_id][r.start : r.start + r.words]) + b" " in joined[r.kept_doc_id]
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in windows_seen(rows).items() if v}


def test_recall_of_banding_alone(spark):
    """Of all pairs of paragraphs at similarity 0.8 or more, by brute force, the share that collides in a band."""
    assert passage_dedup.tune_bands(0.8, 0.99, 16) == (5, 2)
    rng, texts = random.Random(21), []
    for _ in range(90):
        base = [f"{w}{rng.randrange(50)}" for w in words(rng, rng.randrange(40, 120))]
        for _ in range(6):
            t = list(base)
            for _ in range(rng.randrange(len(t) // 20 + 1)):
                t[rng.randrange(len(t))] = "edited"
            texts.append(" ".join(t))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bands = {r.doc_id: [r[b] for b in passage_dedup._BANDS] for r in passage_dedup.paragraph_rows(rows).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    met = sum(any(x == y for x, y in zip(bands[a], bands[b], strict=True)) for a, b in pairs)
    assert len(pairs) > 200 and met / len(pairs) > 0.97


def test_wrapped_paragraphs_join(spark):
    """Edited paragraphs wrapped at 9 and at 12 words a line; a blank line ends a paragraph."""
    rng = random.Random(31)
    base = [f"{w}{k}" for k, w in enumerate(words(rng, 120))]

    def wrapped(w, n):
        return "\n".join(" ".join(w[i : i + n]) for i in range(0, len(w), n))

    edited = [*base[:60], "edited", *base[61:]]
    other = [f"o{k}" for k in range(40)]
    rows = [(0, wrapped(base, 9)), (1, wrapped(other, 10) + "\n\n" + wrapped(edited, 12)), (2, wrapped(words(rng, 120), 11))]
    got = passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).filter("kind = 'paragraph'").collect()
    assert sorted((r.doc_id, r.start, r.words, r.removed, r.kept_doc_id) for r in got) == [(0, 0, 120, False, 0), (1, 40, 120, True, 0)]


def test_passages_of_repeated_and_null_ids(spark):
    rng = random.Random(33)
    a, b = (" ".join(words(rng, 50)) for _ in range(2))
    rows = spark.createDataFrame([(4, a), (4, a), (None, b), (None, b), (2, None), (5, "x " + b)], "doc_id long, text string")
    found = passage_dedup.repeated_passages(rows).collect()
    assert sorted((str(r.doc_id), r.removed, str(r.kept_doc_id)) for r in found if r.kind == "paragraph") == [
        ("4", False, "4"), ("4", True, "4"), ("5", False, "5"), ("None", True, "5"), ("None", True, "5"),
    ]
    assert {str(r.doc_id) for r in found if r.kind == "passage"} == {"4", "None"}


@pytest.mark.parametrize("many", [16, 1])
def test_passages_with_busy_anchors(spark, docs, many):
    """The same words are found when anchors of more than one run in a chunk are read again unasked."""
    got = collections.defaultdict(set)
    for r in passage_dedup.repeated_passages(docs, many).filter("kind = 'passage'").collect():
        got[r.doc_id] |= set(range(r.start, r.start + r.words))
    assert dict(got) == {k: v for k, v in windows_seen(text_rows(docs)).items() if v}


def test_similar_paragraphs_join(spark):
    rng = random.Random(6)
    base = [f"{w}{k}" for k, w in enumerate(words(rng, 120))]
    texts = [list(base) for _ in range(6)]
    for k, t in enumerate(texts):
        t[20 * k] = "edited"  # 5 of 116 shingles differ from the base, 10 of 121 between two: similarity over 0.8
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)] + [(9, " ".join(words(rng, 120)))], "doc_id long, text string")
    found = [r for r in passage_dedup.repeated_passages(rows).collect() if r.kind == "paragraph"]
    assert {r.doc_id for r in found} == set(range(6)) and len({r.cluster for r in found}) == 1
    assert {r.doc_id for r in found if not r.removed} == {0}


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(150):
        s = np.array([rng.randint(1, rng.choice([1, 2, 6])) for _ in range(rng.randrange(50))], dtype=np.int64)
        assert suffix_dedup.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def brute_removed(rows):
    """Of (doc_id, text) rows in order, what their repeated strings of 100 bytes leave."""
    out, seen = [], set()
    for _, text in rows:
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                mark[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        kept = bytes(c for c, m in zip(raw, mark, strict=True) if not m)
        spans = sum(m and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark))
        out.append((len(raw), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removed_rows(df, *args):
    rows = suffix_dedup.remove_repeats(df, *args).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


@pytest.mark.parametrize(("hot", "many"), [(4000, 16), (0, 16), (4000, 1)])
def test_repeated_bytes(docs, empty, hot, many):
    """Also with every anchor treated as a hot one, and with anchors of two runs in a chunk compared unasked."""
    rows = text_rows(docs)
    assert removed_rows(docs, hot, many) == [(False, k, *r) for (k, _), r in zip(rows, brute_removed(rows), strict=True)]
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_repeated_bytes_of_repeated_and_null_ids(spark):
    """Rows of one id in the order of their texts, those without id last; one 32-byte string in every document."""
    rng = random.Random(9)
    common_part = "".join(rng.choice("abcdefgh") for _ in range(32))
    rows = [(k, " ".join(words(rng, 40)) + common_part + " ".join(words(rng, 40))) for k in range(60)]
    rows += [rows[3], rows[3], (7, rows[8][1] + " tail"), (None, rows[5][1]), (None, rows[5][1]), (None, None), (61, common_part * 9)]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = sorted((k is None, k or 0, *r) for (k, _), r in zip(order, brute_removed(order), strict=True))
    assert removed_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == want


def test_sharding(spark, docs, empty):
    got = sharding.shard_documents(docs).collect()
    for r in got:
        score = [hashlib.md5(f"{r.doc_id}:{s}".encode()).hexdigest() for s in range(41)]
        assert r.shard == max(range(40), key=lambda s: score[s]) and r.grown_shard == max(range(41), key=lambda s: score[s])
        assert r.grown_shard in (r.shard, 40)
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in got}
    assert sizes == {k: (len(t.encode()) + 16, zlib.crc32(t.encode())) for k, t in text_rows(docs)}
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(empty).count() == 0
    plan = sharding.shard_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    many = spark.range(4000).withColumnRenamed("id", "k")
    weighted = sharding.rendezvous(many, "k", [1.0, 2.0, 5.0], 2.0)
    counts = {r.shard: r["count"] for r in weighted.groupBy("shard").count().collect()}
    assert abs(counts[0] / 4000 - 0.125) < 0.03 and abs(counts[2] / 4000 - 0.625) < 0.03
    assert weighted.filter("grown_shard <> shard and grown_shard <> 3").count() == 0
    twice = spark.createDataFrame([(None, 3), (1, 2), (1, 1), (1, 2), (None, 1)], "k long, v int").withColumn("shard", F.lit(0))
    for parts in (1, 3):
        numbered = sharding.number_slots(twice.repartition(parts), "k", 5, 1).collect()
        assert sorted((r.slot, r.k, r.v) for r in numbered) == [(0, None, 1), (1, None, 3), (2, 1, 1), (3, 1, 2), (4, 1, 2)]
    cut = sharding.number_slots(weighted, "k", 4000, 3, slot_rows=100)
    per = cut.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.count_distinct("slot").alias("d")).collect()
    assert all(r.n == r.m + 1 == r.d for r in per)
