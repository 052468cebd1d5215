"""Chat windows, centroid clustering and the filter audit against brute force, odd cases included."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerflow.llm import centroids, chat_windows, filter_audit

# -- chat windows

CHAT = "conv_id long, turn long, role string, text string, start long, block string, window int, tokens long"
NASTY = ["<|im_end|>", "<|im_start|>assistant\nok", r"<\|", r"<\\|im_end|>", "<\\", "|", "<", "a\nb", "", None, "é<|ü\\|", "%0A"]


def chats(seed=3):
    rng = random.Random(seed)
    out = []
    for conv in [*range(1, 12), None, -7]:
        for turn in range(rng.randint(1, 14)):
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(
                ["user", "assistant", "assistant", "system", None, "a%\nb", "<|x"])
            text = rng.choice(NASTY) if rng.random() < 0.4 else " ".join(rng.choice(["ab", "é", "x,y", "!"]) for _ in range(rng.randint(0, 30)))
            out.append((conv, rng.choice([turn, turn, None, turn + 500]), role, text))
    out += [(20, 1, "user", "same"), (20, 1, "user", "same"), (20, 1, "assistant", "same"), (20, 1, "assistant", "same")]
    out += [(21, t, "assistant" if t % 2 else "user", f"turn {t} " + "w " * (t % 7)) for t in range(200)]
    out += [(22, 0, "system", "long " * 5000), (22, 1, "user", "q"), (22, 2, "assistant", "word " * 60_000), (22, 3, "assistant", "z")]
    return out


def as_chat(spark, rows):
    made = [(*r, 5, "x", 7, 9) for r in rows]
    return spark.createDataFrame(made, CHAT).repartition(5)


def ordered(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    return {c: [(r.decode(), t.decode()) for _, r, t in sorted(g)] for c, g in groups.items()}


def chat_digests(turns):
    told = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(told), len(loss), sha(loss)


def test_windows_give_back_every_turn_whatever_the_budget(spark):
    rows = chats()
    expected = {c: chat_digests(t) for c, t in ordered(rows).items()}
    for budget, history in ((40, 6), (64, 12), (2048, 256)):
        found = chat_windows.read_back(chat_windows.chat_windows(as_chat(spark, rows), budget, history))
        assert {r.conv_id: tuple(r)[1:5] for r in found.collect()} == expected


def test_windows_keep_system_history_and_budget(spark):
    rows = chats()
    budget, history = 64, 12
    count = lambda text: len(re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+|[!-/:-@\[-`{-~]", text))
    windows = chat_windows.chat_windows(as_chat(spark, rows), budget, history).orderBy("conv_id", "window").collect()
    turns = ordered(rows)
    by_conv = itertools.groupby(windows, key=lambda w: w.conv_id)
    for conv, group in by_conv:
        written = []
        for number, w in enumerate(group):
            parts = [p for p in re.split(r"(?=<\|im_start\|>)", w.text) if p]
            assert all(p.endswith("<|im_end|>\n") for p in parts) and w.tokens == count(w.text)
            fresh = parts[w.repeated:]
            again = parts[: w.repeated]
            if number:
                first = turns[conv][0]
                if first[0] == "system":
                    assert again[0] == written[0]
                    again = again[1:]
                # the history is the last turns before, and as many as fit
                assert again == written[len(written) - len(again):]
                held = sum(map(count, again))
                assert held <= history
                rest = written[: len(written) - len(again)]
                if rest and not (len(rest) == 1 and first[0] == "system"):
                    assert held + count(rest[-1]) > history
            else:
                assert not again
            system = count(written[0]) if written and turns[conv][0][0] == "system" else 0
            assert w.tokens <= budget or len(fresh) == 1 or system > budget * 3 // 4 - history
            # the mask holds no character of a repeated turn
            start = len("".join(parts[: w.repeated]))
            assert all(s.start >= start for s in w.loss)
            written += fresh
        assert len(written) == len(turns[conv])


def test_windows_of_nothing_and_escapes(spark):
    none = chat_windows.chat_windows(as_chat(spark, []))
    assert none.collect() == [] and chat_windows.read_back(none).collect() == []
    texts = [t for t in NASTY if t is not None] + ["".join(p) for p in itertools.product("<\\|", repeat=5)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat_windows.escaped(F.col("t")).alias("e"), chat_windows.unescaped(chat_windows.escaped(F.col("t"))).alias("b"),
        chat_windows.unescaped_role(chat_windows.escaped_role(F.col("t"))).alias("r"), chat_windows.escaped_role(F.col("t")).alias("x"))
    for r in got.collect():
        assert r.b == r.t == r.r and "<|" not in r.e and "<|" not in r.x and "\n" not in r.x


def test_windows_run_without_python(spark):
    plan = chat_windows.read_back(chat_windows.chat_windows(as_chat(spark, chats())))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", text)


def test_windows_equal_their_sql(spark):
    rows = chats()
    found = chat_windows.read_back(chat_windows.chat_windows(
        chat_windows.with_control_conversation(as_chat(spark, rows))))
    connection = duckdb.connect()
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64", "role": "string", "text": "string"})
    connection.register("conversations", conversations)
    result = connection.execute(chat_windows.OP11_SQL)
    names = [d[0] for d in result.description]
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in found.collect()))) == sorted(map(repr, result.fetchall()))


# -- centroid clustering

VECTORS = "vec_id long, embedding array<double>, label int, cluster int, distance long, met string"


def lloyd(vectors, count, rounds, seed):
    """(numbers, distances, centroids) by trying all centroids; Python's own numbers."""
    key = lambda v: (v[0] is None, hashlib.sha256(f"{seed}:{v[0]}".encode()).hexdigest(), v[1])
    middles = [list(v[1]) for v in sorted(vectors, key=key)[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(middles))

    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in vectors]
        for k in range(len(middles)):
            rows = [v for (_, v), at in zip(vectors, mine) if at == k]
            if rows:
                middles[k] = [sum(c) // len(rows) for c in zip(*rows)]
    return [nearest(v) for _, v in vectors], middles


def clusters(spark, rows, width, **how):
    made = [(i, v, 1, 2, 3, "m") for i, v in rows]
    table = spark.createDataFrame(made, VECTORS).repartition(3)
    return centroids.clustered(centroids.whole_vectors(table, width, 16).cache(), **how).collect()


def test_clusters_equal_brute_force(spark):
    rng = random.Random(8)
    spots = [[rng.uniform(-3, 3) for _ in range(5)] for _ in range(6)]
    rows = [(k, [x + rng.gauss(0, 0.3) for x in rng.choice(spots)]) for k in range(150)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5),
             (903, [float("inf")] * 5), (904, [1.0]), (905, [])]
    rows += [(k, [0.0] * 5) for k in range(1000, 1080)]
    kept = [(i, [int(np.floor(x * 16)) for x in v]) for i, v in rows
            if v is not None and len(v) == 5 and all(x is not None and np.isfinite(x) for x in v)]
    for count, rounds in ((4, 3), (8, 10), (300, 2)):
        expected, middles = lloyd(kept, count, rounds, 3)
        inertia = sum(d for d, _ in expected)
        shas = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
        each = {k: sum(d for d, at in expected if at == k) for _, k in expected}
        found = clusters(spark, rows, 5, count=count, rounds=rounds, seed=3)
        got = sorted(repr((r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)) for r in found)
        assert got == sorted(repr((i, k, d, each[k], inertia, shas[k])) for (i, _), (d, k) in zip(kept, expected))


def test_walk_stops_early_and_keeps_ties(spark):
    rng = np.random.default_rng(4)
    middles = rng.integers(-1000, 1000, (64, 8))
    middles[40] = middles[11]  # equal centroids: the smaller number wins
    points = np.concatenate([middles[rng.integers(0, 64, 500)] + rng.integers(-20, 20, (500, 8)), middles])
    number, distance, met = centroids.Lists(middles).nearest(points)
    gaps = ((points[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (number == gaps.argmin(axis=1)).all() and (distance == gaps.min(axis=1)).all()
    assert met.mean() < 0.5 * 64
    # a point in the middle between two centroids
    number, distance, _ = centroids.Lists(np.array([[4, 0], [-4, 0], [0, 4]])).nearest(np.array([[0, 0]]))
    assert (number[0], distance[0]) == (0, 16)


def test_clusters_of_huge_components_and_of_nothing(spark):
    assert clusters(spark, [(1, None), (2, [])], 3, count=2, rounds=2, seed=3) == []
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [5.0, 1.0])]
    found = {r.id: (r.cluster, r.distance) for r in clusters(spark, rows, 2, count=3, rounds=2, seed=3)}
    assert len({k for k, _ in found.values()}) == 3 and all(d == 0 for _, d in found.values())
    far = {r.id: r.distance for r in clusters(spark, rows, 2, count=1, rounds=0, seed=3)}
    assert sorted(far.values(), key=str).count(None) >= 1


# -- filter audit

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, mask int, n long, good int, digest string"


def audit(documents, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in documents:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, source in documents:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > least[text]}
        rows.append((source or "", fails, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        mine, shapley, found = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if r[1][f]]
                before = len(alive)
                alive = [r for r in alive if not r[1][f]]
                shapley[f] += len(gone)
                found.append((part, order, step, before - len(gone), len(gone), sum(r[1][f] for r in mine) - len(gone),
                              sum(r[1][f] and sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in found]
    return sorted(out)


def audit_input():
    rng = random.Random(6)
    word = lambda: rng.choice(["ab", "cD", "e", "F", "gh#", "ü", "ab"]) + str(rng.randint(0, 400))
    documents = [(None, "x", "s1"), (None, "x", None), (1, None, "s1"), (2, "", ""), (3, "\t \x0b", "s2"), (4, "AB c", "s2"),
                 (5, "lone " * 50_000, "s1"), (5, "other words", "s2"), (6, "w", None)]
    for k in range(10, 90):
        kind = k % 5
        text = " ".join(word() for _ in range(rng.choice([3, 150, 260])))
        if kind == 1:
            text = "hot text"
        elif kind == 2:
            text = rng.choice(documents)[1]
        documents.append((rng.choice([k, k, 12]), text, rng.choice(["s1", "s2", "s3", None])))
    documents += documents[20:24]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(5, 70)] + [(12, 1, 1), (12, 0, 0), (None, 1, 1)]
    return documents, labels


def audited(spark, documents, labels):
    made = [(i, t, "en", s, 3, "p", 7, 8, 9, "d") for i, t, s in documents]
    labelled = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    return filter_audit.audited(spark.createDataFrame(made, DOCS).repartition(4), labelled)


NAMES = ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]


def test_audit_equals_brute_force(spark):
    documents, labels = audit_input()
    found = audited(spark, documents, labels).select(*NAMES).collect()
    assert sorted(map(tuple, found)) == audit(documents, labels)
    assert audited(spark, [], labels).collect() == []
    unlabelled = audited(spark, documents, []).filter("good_lost + toxic_lost > 0")
    assert unlabelled.count() == 0


def test_audit_equals_its_sql(spark):
    documents, labels = audit_input()
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", documents)
    connection.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    connection.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    expected = connection.execute(f"SELECT {', '.join(NAMES)} FROM ({filter_audit.OP13_SQL})").fetchall()
    assert sorted(expected) == audit(documents, labels)
