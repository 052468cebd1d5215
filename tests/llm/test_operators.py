"""The ten operators against brute force, on texts with copies, gaps and odd cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import (
    decontamination,
    graph,
    language_id,
    maxent_lm,
    near_dedup,
    packing,
    quality,
    repair_tokens,
    substring_dedup,
    tokens,
    topk_search,
    url_filter,
    words,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators give to their results, or use on the way
    "n_words long, score double, copy long, node long, held_out boolean, place int, `start` int"
)
BLANK_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def blank_words(text):
    return BLANK_WORDS.findall((text or "").encode())


def lowered(text):
    return (text or "").encode().lower()


def corpus(seed=1, count=60):
    """(doc_id, text): sentences with copies, near copies, shared passages and odd cases."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(70)
    out = []
    for k in range(count):
        kind = k % 6
        if kind == 0 or not out:
            body = text(rng.randint(1, 120))
        elif kind == 1:
            body = rng.choice(out)[1]  # exact copy
        elif kind == 2:  # near copy
            parts = (rng.choice(out)[1] or "").split()
            if parts:
                parts[rng.randrange(len(parts))] = "changed"
            body = " ".join(parts)
        elif kind == 3:
            body = f"{text(30)}\n{passage}\t{text(20)}"
        elif kind == 4:
            body = text(1) + f" {passage[: len(passage) // 2]} " + text(40).upper()
        else:
            body = " ".join(["same"] * 130) if k % 4 else text(3)
        out.append((k * 3 + 1, body))
    out += [(500, None), (501, ""), (502, "   \n"), (503, text(4000)), (504, "..."), (505, "12 34"),
            (506, out[3][1]), (506, out[3][1]), (507, "a <|endoftext|> b"), (508, "naïve  Ünïcode\u00a0x")]
    rng.shuffle(out)
    return out


def frame(spark, rows, parts=3):
    made = [(i, t, "en", "src0", len(t or ""), 7, 0.5, 9, 11, True, 3, 4) for i, t in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(parts)


def by_id(found, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in found.collect()}


# -- shared helpers


def test_grams_depend_on_words_alone():
    import pyarrow as pa

    column = pa.array(["a b c d e", None, "", "x a b c d e", "b c d"])
    _, _, data, offsets = next(words.text_slices(column))
    found = words.split_words(data, offsets, words.UNBLANK)
    assert np.diff(found.first).tolist() == [5, 0, 0, 6, 3]
    three = words.gram_values(found.values, 3)
    assert three[1] == three[7] == three[11]
    assert words.room(found).tolist() == [5, 4, 3, 2, 1, 6, 5, 4, 3, 2, 1, 3, 2, 1]


def test_sliding_min_and_cover():
    values = np.array([5, 3, 9, 1, 7, 7], dtype=np.uint64)
    for width in range(1, 8):
        assert words.sliding_min(values, width).tolist() == [int(values[i : i + width].min()) for i in range(6)]
    assert words.covered(np.array([1, 2]), 2, 6).tolist() == [False, True, True, True, False, False]


def test_components_of_chain_and_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long"))
    label = {r.node: r.component for r in found.collect()}
    assert label == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}
    more = spark.createDataFrame([(129, 500), (500, 600), (3, 700)], "a long, b long")
    label = {r.node: r.component for r in graph.merged(found, more).collect()}
    assert label == {k: 0 for k in [*range(41), 700]} | {k: 100 for k in [*range(100, 130), 500, 600]}
    none = graph.components(spark.createDataFrame([], "a long, b long"))
    assert none.collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_encode_like_whole_texts(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    encoder, whole = tokens.Encoder(path), Tokenizer.from_file(path)
    texts = [t for _, t in corpus()] + ["a  b \n c", " x", "x ", "\x1c a\x1cb", "don't 12", "É ́b", "z" * 200 + " " + "y" * 100]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids


# -- 1


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for ids in (np.tile([1, 2, 3, 1, 2], 3000), np.full(1001, 7), rng.integers(0, 5, 5000), np.zeros(0, int), np.array([4])):
        symbols, rules = repair_tokens.pair_rules(ids.astype(np.uint32), 10, min_count=4)
        sizes = repair_tokens.expansions(rules, 10)
        whole = repair_tokens.decode_range(symbols, rules, sizes, 10, 0, len(ids))
        assert (whole == ids).all()
        assert len(ids) < 1000 or len(symbols) < len(ids) / 2
        for _ in range(20):
            low, high = sorted(rng.integers(0, len(ids) + 1, 2))
            assert (repair_tokens.decode_range(symbols, rules, sizes, 10, low, high) == ids[low:high]).all()


def test_repair_documents(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = corpus() + [(None, "no id")]
    blocks = repair_tokens.grammar_blocks(frame(spark, rows), path, 2, 49408, block_ids=500)
    found = repair_tokens.read_documents(blocks).orderBy("start").collect()
    whole, start = Tokenizer.from_file(path), 0
    assert [r.doc_id for r in found] == [i for i, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    text = {i: t for i, t in rows}
    for row in found:
        ids = whole.encode(text[row.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)


# -- 2


def test_url_rules(spark):
    urls = [
        "http://a.example.net/en/1", "http://a.example.net/fr/1?x=/en/", "HTTPS://EXAMPLE.NET/en/", "http://notexample.net/en/x",
        "http://example.com/de/1", "http://example.com/de", "http://www.example.org/fr/x#y", "http://org/fr/", "ftp://x.org/frx",
        "http://cheap-pills.example.com/en/1", "http://net", "http://net/", "no scheme", "", None, "://", "a://b://c/d",
        "http://x.net?q=1", "http://example.com/DE/1", "http://ex%61mple.com/de/\nq", "http://example.com/de/1",
    ]
    pages = spark.createDataFrame([(k, u, "<p>", "rule", "net/") for k, u in enumerate(urls)],
                                  "page_id long, url string, html string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(pages).collect()}
    assert len(got) == len(urls)
    for k, url in enumerate(urls):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in url_filter.HOST_RULES
                if (host == r.name.partition("/")[0] or host.endswith("." + r.name.partition("/")[0]))
                and path.startswith("/" + r.name.partition("/")[2])]
        best = max(fits, key=lambda r: len(r.name), default=None)
        verdict = best.verdict if best else "block" if any(re.search(r.pattern, host + path) for r in url_filter.PATTERN_RULES) else "allow"
        assert got[k] == (host, path, best and best.name, verdict), url


def test_url_rules_of_several_tokens(spark):
    hosts = ["ad.a.com", "ads.a.com", "track.b.org", "tracking.b.org", "tracker.b.org", "adx.a.com", "a.ads.com", "trackers.b.org",
             "adult.d.com", "adultsite.d.com", "adult-site.d.com", "www.my-adults.d.com", "xxx.c.com", "xxx-pics.c.com",
             "www.xxxpics.c.com", "notadult.d.com", "adult9.d.com", "axxx.c.com", "ADS.a.com", "XxxPics.c.com", "d.com-xxx"]
    urls = [f"http://{h}/{p}" for h in hosts for p in ("", "xxx.y/adult.z")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judged(pages).collect()}
    blocked = []
    for k, url in enumerate(urls):
        target = url.split("://", 1)[1].lower()
        hit = any(re.search(r.pattern, target) for r in url_filter.PATTERN_RULES)
        assert got[k] == ("block" if hit else "allow"), url
        blocked += [target] * hit
    assert len(blocked) == 28


def test_url_rules_on_no_pages(spark):
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string")).collect() == []


# -- 3


def brute_hits(rows, items, size):
    windows = defaultdict(set)
    for item, text in items:
        own = ALNUM_WORDS.findall(lowered(text))
        n = min(len(own), size)
        for k in range(len(own) - n + 1 if n else 0):
            windows[tuple(own[k : k + n])].add(item)
    out = []
    for doc, text in rows:
        own = ALNUM_WORDS.findall(lowered(text))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(own) - n + 1):
                if (w := tuple(own[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[w]
        out.append((doc, len(own), len(hit), sorted(map(str, found))))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [10, 6])
def test_decontamination(spark, size):
    rows = corpus() + [(None, "x y z")]
    pick = lambda k, a, b: " ".join((rows[k][1] or "").split()[a:b])
    items = [(1, pick(0, 0, 40)), (2, pick(5, 3, 16)), (20, "same same same"), (3, None), (4, ""), (5, "..."),
             (6, "same " * 12), (7, rows[7][1]), (8, rows[7][1]), (9, "never to be seen here")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    found = decontamination.contaminated_words(frame(spark, rows), bench, window=size).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, sorted(map(str, r.item_ids or []))) for r in found), key=str)
    assert got == brute_hits(rows, items, size)
    nothing = decontamination.contaminated_words(frame(spark, rows), bench.limit(0)).agg(F.sum("n_hit"), F.count("*")).first()
    assert tuple(nothing) == (0, len(rows))


# -- 4


def test_language_model_counts_and_base(spark):
    rows = corpus(count=90)
    found = maxent_lm.scored(frame(spark, rows)).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    end = object()
    of = lambda t: lowered(t).split() + [end]
    counts = Counter(itertools.chain.from_iterable(of(t) for i, t in rows if not held(i)))
    n, v = sum(counts.values()), len(counts)
    want = sorted((i, held(i), len(of(t)), sum(counts[w] > 0 for w in of(t)), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in of(t)), 5)) for i, t in rows)
    got = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found)
    assert got == want
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
    assert all(r.score < 0 for r in found)


def test_language_model_softmaxes_sum_to_one():
    model = maxent_lm.Model(np.arange(maxent_lm.SLOTS).astype(float))
    model.weights = np.random.default_rng(1).normal(size=model.weights.shape).astype(np.float32)
    features = np.random.default_rng(2).integers(0, 1 << 62, (1, maxent_lm.FEATURES)).astype(np.uint64)
    every = np.arange(maxent_lm.SLOTS)
    total = (10 ** model.log10(np.repeat(features, len(every), axis=0), every)).sum()
    assert abs(total - 1) < 1e-4


def test_language_model_sees_three_tokens_back():
    texts = [b"aa x y z", b"bbb x y z"]
    tokens = maxent_lm.Tokens(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)]))
    tokens.slot = np.unique(tokens.value, return_inverse=True)[1]
    features = tokens.features().reshape(2, 5, -1)
    assert (features[0, 3] != features[1, 3]).sum() == 1 and (features[0, 4] == features[1, 4]).all()


def test_language_model_members_depend_on_the_pair_before():
    model = maxent_lm.Model(np.ones(maxent_lm.SLOTS))
    features = np.random.default_rng(4).integers(0, 1 << 62, (1, maxent_lm.FEATURES)).astype(np.uint64)
    other = features.copy()
    other[:, -1] += np.uint64(1)
    both = np.repeat(np.concatenate([features, other]), 2000, axis=0)
    slots = np.repeat([70, 71], 2000)
    mixed = np.random.default_rng(5).permutation(4000)
    for _ in range(30):
        model.learn(both[mixed], slots[mixed], np.zeros(len(model.weights)), np.zeros(len(model.weights)))
    assert 10 ** model.log10(np.concatenate([features, other]), np.array([70, 71])).min() > 0.7


def test_language_model_grows_with_the_vocabulary():
    assert maxent_lm.sizes(0) == maxent_lm.sizes(1 << 20) == (32, 1 << 14)
    assert maxent_lm.own_slots(32 * 32) == 256
    grown = [maxent_lm.sizes(1 << k) for k in (20, 22, 24, 28, 36)]
    assert [s for s, _ in grown] == [32, 46, 64, 128, 512]
    assert grown[1][1] == 1 << 16 and all(3 * s * r <= maxent_lm.WEIGHTS for s, r in grown)
    side, rows = grown[1]
    model = maxent_lm.Model(np.arange(side * side).astype(float), rows)
    rng = np.random.default_rng(3)
    features = rng.integers(0, 1 << 62, (9000, maxent_lm.FEATURES)).astype(np.uint64)
    model.learn(features, rng.integers(0, side * side, 9000), np.zeros(len(model.weights)), np.zeros(len(model.weights)))
    every = np.arange(side * side)
    total = (10 ** model.log10(np.repeat(features[:1], len(every), axis=0), every)).sum()
    assert abs(total - 1) < 1e-4
    keys = rng.integers(0, 3 * rows, 5000)
    assert (maxent_lm.order_of(keys) == np.argsort(keys, kind="stable")).all()


def test_language_model_without_documents(spark):
    assert maxent_lm.scored(frame(spark, []).limit(0)).collect() == []


# -- 5


def test_differencing_is_near_equal_and_whole():
    rng = np.random.default_rng(5)
    for count in (0, 1, 7, 900):
        lengths = rng.integers(1, 257, count)
        windows = packing.windows_of(lengths, 2048) if count else []
        assert sorted(itertools.chain.from_iterable(windows)) == list(range(count))
        sums = [int(lengths[w].sum()) for w in windows]
        assert all(s <= 2048 for s in sums)
        if count == 900:
            assert len(windows) <= lengths.sum() // 2048 + 2 and max(sums) - min(sums) < 40
    assert sorted(map(sorted, packing.differencing(np.array([8, 7, 6, 5, 4]), 2))) in ([[0, 1], [2, 3, 4]], [[0, 3], [1, 2, 4]], [[0, 2], [1, 3, 4]])


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = corpus()
    found = packing.packed(frame(spark, rows), path, 1, group_windows=2).collect()
    whole = Tokenizer.from_file(path)
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        ends = list(itertools.accumulate(r.length for r in pieces))
        assert [r.offset for r in pieces] == [0, *ends[:-1]] and ends[-1] <= 2048
    text = dict(rows)
    assert set(documents) == set(text)
    for doc, pieces in documents.items():
        ids = whole.encode(text[doc] or "", add_special_tokens=False).ids + [1]
        copies = sum(i == doc for i, _ in rows)
        covered = Counter()
        for r in pieces:
            own = np.array(ids[r.start : r.start + r.length], dtype="<u4")
            assert len(own) == r.length and r.ids_crc32 == zlib.crc32(own.tobytes()) and r.doc_tokens == len(ids)
            covered.update(range(r.start, r.start + r.length))
        assert covered == {k: copies for k in range(len(ids))}
    assert packing.packed(frame(spark, []).limit(0), path, 1).collect() == []


# -- 6


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "ROWS", 40)
    monkeypatch.setattr(topk_search, "QUERIES", 3)
    rng = np.random.default_rng(9)
    rows = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(300)]
    rows += [(300 + k, [0.5, 0.25, 0.0, 0.0, -0.5, 1.0]) for k in range(60)]  # ties
    rows += [(400, [0.0] * 6), (401, None), (402, [1.0, None]), (403, [float("nan")]), (404, [float("inf")]),
             (450, [1.0, -2.0]), (451, []), (None, [1.0] * 6), (50, [9.0] * 6)]
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, block int, part int").repartition(4)
    numbers = topk_search.whole_numbers(vectors)
    got = defaultdict(list)
    for r in topk_search.searched(numbers, numbers.filter("id % 50 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for query, own in fine:
        if query % 50 or query == 50:
            continue
        dots = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in fine if i != query)[:5]
        assert got[query] == [(n, i, -s) for n, (s, i) in enumerate(dots, 1)]
    assert topk_search.searched(numbers.limit(0), numbers, 5).collect() == []
    assert topk_search.searched(numbers, numbers.limit(0), 5).collect() == []


def test_topk_deals_rows_once_and_pairs_blocks_without_a_join(spark, monkeypatch, capsys):
    monkeypatch.setattr(topk_search, "ROWS", 40)
    vectors = spark.range(500).select(F.col("id"), F.array(F.col("id") % 7, F.col("id") % 11).alias("vector"))
    numbered, blocks = topk_search.dealt(vectors.repartition(7), 40, "block")
    assert blocks == 13 and numbered.count() == 500
    # other partitions, same blocks
    again = numbered.repartition(3).join(numbered.withColumnRenamed("block", "other"), "id")
    assert again.filter("block != other").count() == 0
    topk_search.searched(vectors, vectors.filter("id % 50 = 0"), 3).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# -- 7


def brute_kept(rows, size):
    first = {}
    for doc, text in rows:
        own = blank_words(text)
        for k in range(len(own) - size + 1):
            w = tuple(own[k : k + size])
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        own = blank_words(text)
        gone = set()
        for k in range(len(own) - size + 1):
            if first[tuple(own[k : k + size])] < doc:
                gone |= set(range(k, k + size))
        kept = b" ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((doc, len(own), len(gone), kept.decode()))
    return sorted(out)


@pytest.mark.parametrize("size, first_length", [(50, None), (50, 13), (20, 5), (7, 7)])
def test_substring_dedup(spark, size, first_length):
    rows = corpus()
    found = substring_dedup.without_repeats(frame(spark, rows), size, first_length, carry=["lang", "n_words", "text"])
    assert found.columns == ["doc_id", "n_words", "n_removed", "removed", "kept_text", "lang", "text"]
    out = found.collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out) == brute_kept(rows, size)
    for r in out:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_substring_dedup_without_ids(spark):
    rows = [(None, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, None)]
    found = substring_dedup.without_repeats(frame(spark, rows), 3).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("1", 0), ("2", 4), ("None", 0), ("None", 0)]


def test_a_value_that_many_documents_share_keeps_each_of_their_rows_once(spark):
    passage = " ".join(f"p{k}" for k in range(80))
    survivors = []
    for n in (20, 80):
        docs = frame(spark, [(d, " ".join(f"w{d}x{k}" for k in range(40)) + " " + passage) for d in range(n)])
        rows = substring_dedup.level(substring_dedup.keyed(docs), 50, 25, None).localCheckpoint()
        found = substring_dedup.repeated(rows)
        # one row a value, so a join with it gives no row twice
        assert found.count() == found.select("gram").distinct().count()
        survivors.append(rows.join(found, "gram").count())
        assert survivors[-1] == rows.join(found, "gram", "left_semi").count() <= rows.count()
    assert 0 < survivors[1] == 4 * survivors[0]


def test_a_word_said_again_and_again_is_one_row_of_a_document(spark):
    texts = {d: "of " * (120 + d) + " ".join(f"w{d}x{k}" for k in range(60)) for d in range(12)}
    texts[12] = texts[3]
    rows = list(texts.items())
    docs = substring_dedup.keyed(frame(spark, rows))
    level = substring_dedup.level(docs, 50, 25, None).localCheckpoint()
    assert level.groupBy("doc_id", "copy", "gram").count().filter("count > 1").isEmpty()
    # the 95 or more places of the word are all there
    most = level.filter("doc_id = 0").selectExpr("max(1 + coalesce(size(more), 0))").first()[0]
    assert most >= 95
    shared = level.join(substring_dedup.repeated(level), "gram", "left_semi").filter("doc_id not in (3, 12)")
    assert shared.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 1
    found = substring_dedup.without_repeats(frame(spark, rows + rows[:2]), 50).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == sorted(
        brute_kept(rows, 50) + [r for r in brute_kept(rows, 50) if r[0] < 2])


# -- 8


def brute_groups(rows, size, percent):
    sets = []
    for doc, text in rows:
        own = lowered(text).split()
        n = min(size, len(own))
        sets.append((doc, {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()))
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            parent[root(a)] = root(b)
    least = {}
    for k, (doc, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), doc), doc)
    return sorted((doc, len(s), least[root(k)], least[root(k)] == doc) for k, (doc, s) in enumerate(sets))


@pytest.mark.parametrize("small, lanes", [(16, 64), (2, 2)])
def test_near_duplicates(spark, monkeypatch, small, lanes):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "LANES", lanes)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    rows = corpus()
    for k in range(25):  # a family whose members are not all alike
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((1000 + k, " ".join(own)))
    for k in range(25):  # short texts with a common line
        rows.append((2000 + k, "one line that very many of the short texts have " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(4))))
    found = near_dedup.near_duplicates(frame(spark, rows), 4, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == brute_groups(rows, 4, 80)


def test_near_duplicates_linked_through_a_row_without_id(spark):
    text = lambda low: " ".join(f"w{k}" for k in range(low, low + 60))
    rows = [(1, text(0)), (None, text(5)), (2, text(10)), (None, "some other text"), (None, None), (3, "w1 w2")]
    found = near_dedup.near_duplicates(frame(spark, rows), size=1, percent=80).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str)
    assert got == sorted([(1, 60, 1, True), (2, 60, 1, False), (3, 2, 3, True), (None, 60, 1, False),
                          (None, 3, None, False), (None, 0, None, False)], key=str)


def test_near_duplicates_without_ids_or_rows(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (None, ""), (4, None)]
    found = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in found), key=str) == [
        (3, 3, True), (4, 4, True), (None, 3, False), (None, None, False)]
    assert near_dedup.near_duplicates(frame(spark, []).limit(0)).collect() == []


def test_register_estimates_are_close():
    rng = np.random.default_rng(8)
    for n, shared in ((2000, 1700), (300, 240), (20000, 10000)):
        both = np.unique(rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64) * 2)
        left, right = np.sort(both[:n]), np.sort(both[len(both) - n :])
        first = np.array([0, n])
        a, b = near_dedup.registers(left, first), near_dedup.registers(right, first)
        found, _ = near_dedup.estimate(a, b, np.array([n]), np.array([n]))
        truth = len(np.intersect1d(left, right)) / len(both)
        assert abs(found[0] - truth) < 0.2


# -- 9


def test_quality_learns_from_positives_and_unlabelled(spark):
    rng = random.Random(2)
    good = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(60)) + "."
    bad = lambda: " ".join("".join(rng.choice("ABCDEFGH") for _ in range(5)) + "!!" for _ in range(60))
    rows = [(k, good() if k % 4 else bad()) for k in range(400)] + [(900, None), (901, ""), (None, good()), (1, good())]
    labels = [(k, int(k % 4 > 0), 0) for k in range(0, 400, 2)] + [(None, 1, 0), (5, None, 0), (7777, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality.quality_scores(frame(spark, rows), marks, carry=["lang", "score", "text"])
    assert found.columns == ["doc_id", "lang", "text", "score", "held_out", "predicted"]
    out = found.collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    right = [r.predicted == int(r.doc_id % 4 > 0) for r in out if r.doc_id is not None and r.doc_id < 400]
    assert sum(right) >= 0.97 * len(right)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)


def quality_rows(seed, count=150, good=0.5):
    """(rows, ids of good ones): clean sentences and shouted junk."""
    rng = random.Random(seed)
    clean = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(60)) + "."
    junk = lambda: " ".join("".join(rng.choice("ABCDEFGH") for _ in range(5)) + "!!" for _ in range(60))
    wanted = {k for k in range(count) if rng.random() < good}
    return [(k, clean() if k in wanted else junk()) for k in range(count)], wanted


@pytest.mark.parametrize("share", [0.3, 0.8])
def test_quality_from_positives_alone_orders_and_estimates_the_prior(spark, monkeypatch, share):
    rows, good = quality_rows(4, 400, share)
    # half of the good ones are trusted; nothing else has a label
    marks = spark.createDataFrame([(k, 1) for k in sorted(good) if k % 2], "doc_id long, quality int")
    seen = []
    fit = quality.non_negative
    monkeypatch.setattr(quality, "non_negative", lambda u, p, prior, w: seen.append(prior) or fit(u, p, prior, w))
    out = quality.quality_scores(frame(spark, rows), marks).collect()
    assert abs(seen[0] - len(good) / len(rows)) < 0.1
    low = min(r.score for r in out if r.doc_id in good and r.held_out)
    assert low > max(r.score for r in out if r.doc_id not in good and r.held_out)


def test_quality_learns_from_every_unlabelled_text(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 20)
    rows, good = quality_rows(5, 300)
    marks = spark.createDataFrame([(k, 1) for k in sorted(good)], "doc_id long, quality int")
    counts = []
    keep = quality.estimated_prior
    monkeypatch.setattr(quality, "estimated_prior", lambda p, above, n: counts.append((len(p), n)) or keep(p, above, n))
    quality.quality_scores(frame(spark, rows), marks)
    positives, unlabelled = counts[0]
    assert 0 < positives <= 20
    assert unlabelled == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k, _ in rows)


def test_quality_risk_slope_and_curvature_by_a_plain_loop(spark):
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(size=(40, 3)), np.ones(40)]).astype(np.float32).astype(float)
    w = rng.normal(size=4)
    stored = spark.createDataFrame([(r.astype(np.float32).tobytes(),) for r in x], "x binary").repartition(5)
    for sign in (1, -1):
        found = quality.sums(stored, lambda m, sign=sign: quality.loss_sums(m, w, sign))
        loss, slope, curve = quality.split(found, 40)
        plain_loss, plain_slope, plain_curve = 0.0, [0.0] * 4, np.zeros((4, 4))
        for row in x:
            z = sum(a * b for a, b in zip(row, w))
            at = 1 / (1 + math.exp(-z))
            plain_loss += math.log1p(math.exp(sign * z)) / 40
            for k in range(4):
                plain_slope[k] += (at if sign > 0 else at - 1) * row[k] / 40
                for j in range(4):
                    plain_curve[k, j] += at * (1 - at) * row[k] * row[j] / 40
        assert math.isclose(loss, plain_loss) and np.allclose(slope, plain_slope) and np.allclose(curve, plain_curve)


def test_quality_fit_keeps_the_second_term_from_falling_below_zero():
    rng = np.random.default_rng(7)
    ones = lambda m: np.column_stack([m, np.ones(len(m))])
    positive = ones(rng.normal(1, 1, size=(30, 20)))
    unlabelled = ones(np.vstack([rng.normal(1, 1, size=(60, 20)), rng.normal(-1, 1, size=(60, 20))]))
    measure = lambda w: quality.split(quality.loss_sums(unlabelled, w, 1), len(unlabelled))
    # a prior far too high asks for more than there is
    w = quality.non_negative(measure, positive, 0.9, np.append(np.zeros(20), 2.0))
    rest = np.logaddexp(0, unlabelled @ w).mean() - 0.9 * np.logaddexp(0, positive @ w).mean()
    assert rest >= -1e-6 and np.isfinite(w).all()


def test_quality_without_labels_or_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = frame(spark, [(1, "a b"), (2, None)])
    assert {r.score for r in quality.quality_scores(rows, empty).collect()} == {0.5}
    assert quality.quality_scores(rows.limit(0), empty).collect() == []
    bad = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(rows, bad).collect()} == {0.5}


# -- 10


def language_rows():
    rng = random.Random(6)
    sounds = {"en": ["the", "ing", "th", "er", "an"], "de": ["sch", "ung", "ch", "ei", "der"], "fr": ["eau", "é", "que", "oi", "les"]}
    line = lambda lang, n: " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(k, line(lang, rng.randint(3, 60)), lang) for k in range(240) for lang in [list(sounds)[k % 3]]]
    rows += [(700, line("en", 60) + " " + line("de", 30), None), (701, None, "en"), (702, "", "fr"), (703, "12 !? 3", "de"), (None, line("fr", 20), "fr")]
    return rows


def test_languages(spark):
    rows = language_rows()
    docs = spark.createDataFrame([(i, t, g, 0.1) for i, t, g in rows], "doc_id long, text string, lang string, score double")
    out = language_id.languages(docs).collect()
    assert len(out) == len(rows)
    found = {r.doc_id: r for r in out}
    assert all(found[i].lang_pred == g for i, _, g in rows[:240])
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (701, 702, 703))
    mixed = found[700]
    assert mixed.lang_pred == "en" and [s.lang for s in mixed.shares] == ["en", "de"] and 0.5 < mixed.score < 0.85
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)


def brute_mixture(likelihood, weight):
    """Shares of one text by very many rounds, and of the languages that pay."""
    def climb(share):
        for _ in range(5000):
            joint = np.exp(likelihood) * share
            share = (joint * (weight / joint.sum(axis=1))[:, None]).sum(axis=0) / weight.sum()
        return share, (weight * np.log((np.exp(likelihood) * share).sum(axis=1))).sum()

    share, fit = climb(np.full(likelihood.shape[1], 1 / likelihood.shape[1]))
    while (share > 0).sum() > 1:
        fewer = share.copy()
        fewer[np.where(share > 0, share, np.inf).argmin()] = 0
        fewer, worse = climb(fewer / fewer.sum())
        if fit - worse > 2 + 0.5 * math.log(weight.sum()):
            break
        share, fit = fewer, worse
    return share, fit


def test_mixtures_are_converged():
    rng = np.random.default_rng(11)
    parts, weights = [], []
    for size in (1, 40, 700, 1500, 6000):  # related languages, the second one a minority
        base = rng.normal(-6, 1, (size, 1))
        words = base + rng.normal(0, 0.6, (size, 4))
        true = rng.choice(4, size, p=[0.8, 0.2, 0, 0])
        words[np.arange(size), true] += 1
        parts.append(words)
        weights.append(rng.integers(1, 4, size).astype(float))
    text = np.repeat(np.arange(len(parts)) + 1, list(map(len, parts)))
    some, share, fit = language_id.mixtures(np.concatenate(parts), text, np.concatenate(weights), len(parts) + 2)
    assert some.tolist() == [1, 2, 3, 4, 5]
    for k, (words, weight) in enumerate(zip(parts, weights)):
        want, best = brute_mixture(words, weight)
        assert ((share[k] > 0) == (want > 0)).all() and abs(fit[k] - best) < 2e-3 and np.abs(share[k] - want).max() < 5e-3


def test_languages_with_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [tuple(r[:3]) for r in language_id.languages(docs).collect()] == [(1, "und", 0.0)]
    assert language_id.languages(docs.limit(0)).collect() == []


# -- digests of the registered queries


def test_query_digests(spark, sf_dir):
    from ledgerflow.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
            for d, n, h, i in brute_hits(list(texts.items()), items, 10)}
    found = QUERIES["op3_winnowing"](spark, sf_dir)
    assert by_id(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want


def test_sums_of_runs_are_those_of_the_rows():
    rng = np.random.default_rng(3)
    keys, values = np.sort(rng.integers(0, 40, 120)), rng.random((30, 5), dtype=np.float32)
    order = rng.integers(0, 30, 120)
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    times = np.diff(np.append(heads, len(keys)))
    right = [values[order[b : b + n]].astype(float).sum(axis=0) for b, n in zip(heads, times)]
    assert np.allclose(maxent_lm.run_sums(values, order, heads, times), right, rtol=1e-5)
    alone = maxent_lm.run_sums(values, order[:4], np.arange(4), np.ones(4, np.int64))
    assert (alone == values[order[:4]]).all()


def test_shingles_of_one_set_alone_are_counted_and_not_ranked(spark, monkeypatch):
    written = {}
    staged = near_dedup.staged
    monkeypatch.setattr(near_dedup, "staged", lambda f, name: written.setdefault(name, staged(f, name)))
    rng = random.Random(4)
    sets = {node: sorted(rng.sample(range(60), rng.randint(1, 30)) + [1000 + node]) for node in range(25)}
    rows = [(node, np.array(s, dtype=np.uint64).tobytes()) for node, s in sets.items()]
    got = near_dedup.prefixes(spark.createDataFrame(rows, "node long, shingles binary"), 80)
    often = Counter(v for s in sets.values() for v in s)
    right = set()
    for node, s in sets.items():
        ranked = sorted(s, key=lambda v: (often[v], v))
        most = len(s) - math.ceil(len(s) * 80 / 100) + 1
        right |= {(v, node, len(s), k) for k, v in enumerate(ranked, 1) if k <= most and often[v] > 1}
    assert {tuple(r) for r in got.collect()} == right
    assert written["near-often"].filter("sets < 2").isEmpty()


def test_rounds_of_comparing_are_given_the_classes_of_split_groups_alone(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "LANES", 2)
    given, compared = {}, near_dedup.compared

    def seen(rows, label, nodes, sets, percent):
        given.update(rows={r.node for r in rows.select("node").collect()},
                     nodes=sorted(r.node for r in nodes.collect()), sets=sorted(r.node for r in sets.collect()))
        return compared(rows, label, nodes, sets, percent)

    monkeypatch.setattr(near_dedup, "compared", seen)
    rng = random.Random(4)
    rows = []
    for k in range(25):  # a family whose members are not all alike
        own = [f"w{j}" for j in range(60)]
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    for k in range(0, 40, 2):  # pairs of near copies, none of which is in a large group
        own = [f"p{k}q{j}" for j in range(60)]
        rows += [(100 + k, " ".join(own)), (101 + k, " ".join(own[:-1] + ["other"]))]
    found = near_dedup.near_duplicates(frame(spark, rows), 4, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == brute_groups(rows, 4, 80)
    assert given["nodes"] == given["sets"]
    assert given["rows"] <= set(given["nodes"]) and 0 < len(given["nodes"]) <= 25
