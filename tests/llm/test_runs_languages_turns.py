"""Periodic runs, language by byte contexts and repair of turns against brute force, with nulls, ties, repeats, long texts."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from carelattice.llm import conversations, langid, periodic, queries

SPACES = re.compile(rb"[\x20\x09-\x0D]+")
EXTRA = "lang string, runs string, collapsed string, n_words int, part int, whole string"
SCHEMA = f"doc_id long, text string, {EXTRA}"


def words(text: str | None) -> list[bytes]:
    return [w for w in SPACES.split((text or "").encode()) if w]


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "x", "x", "x", 1, 2, "x") for i, t in pairs], SCHEMA).repartition(3)


# -- periodic runs -----------------------------------------------------------------------------


def brute_runs(w: list) -> list[tuple[int, int, int]]:
    """All maximal stretches per lag; of one stretch the smallest lag counts."""
    found = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.append((i, j + q - i, q))
            i = j
    smaller = lambda a, b: b[2] < a[2] and b[0] <= a[0] and b[0] + b[1] >= a[0] + a[1]
    return sorted((r for r in found if not any(smaller(r, o) for o in found)), key=lambda r: (r[0], r[2]))


def cyclic(k: int, letters: int, times: int, rng) -> list[int]:
    """A cyclic word in which every k-gram occurs `times` times: an Euler circuit of repeated k-gram edges."""
    nodes = defaultdict(list)
    for g in itertools.product(range(letters), repeat=k):
        for _ in range(times):
            nodes[g[:-1]].append(g[1:])
    for out in nodes.values():
        rng.shuffle(out)
    stack, circuit = [(0,) * (k - 1)], []
    while stack:
        if nodes[stack[-1]]:
            stack.append(nodes[stack[-1]].pop())
        else:
            circuit.append(stack.pop()[-1])
    return circuit[:-1]


def run_texts() -> list[str | None]:
    rng = random.Random(3)
    some = lambda n, letters: [rng.choice("abcdefghijklmnopqrst"[:letters]) for _ in range(n)]
    texts: list[str | None] = [None, "", " \n\t", "one", "a " * 23, "a " * 24, "a " * 25, "a b " * 11 + "a", "a b " * 12]
    for q in (1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 34, 63, 64, 65, 70, 129):
        unit = some(q, 20)
        for n in (max(24, 3 * q) - 1, max(24, 3 * q), 4 * q + 25):
            texts.append(" ".join(some(5, 4) + (unit * (n // q + 1))[:n] + some(6, 4)))
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            unit = some(rng.randint(1, 12), 3)
            parts += unit * rng.randint(1, 9) + some(rng.randint(0, 4), 3)
        texts.append("\n".join(parts))
    texts.append(" ".join(some(600, 2)))
    texts.append(" ".join(f"w{x}" for x in cyclic(5, 2, 2, rng) * 5))
    texts.append(" ".join(some(200, 20) * 4 + some(9000, 20) + ["z"] * 5000))
    return texts


def test_periodic_runs(spark):
    texts = run_texts()
    rows = [*enumerate(texts), (3, texts[3]), (20, texts[20]), (None, texts[20])]
    got = periodic.periodic_runs(frame(spark, rows)).collect()
    want = Counter()
    for i, t in rows:
        w = words(t)
        found = brute_runs(w) if len(w) < 2000 else None
        if found is None:  # the long text holds what was put in
            found = [(0, 800, 200), (9800, 5000, 1)]
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        want[(i, len(w), tuple(found), b" ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    have = Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), bytes(r["collapsed"])) for r in got)
    assert have == want
    assert sum(len(k[2]) for k in want) > 60
    assert periodic.periodic_runs(frame(spark, [])).count() == 0


def test_each_lag_is_extended_once(monkeypatch):
    compared = []
    real = periodic._equal_from
    monkeypatch.setattr(periodic, "_equal_from", lambda *a: compared.append(1) or real(*a))
    w = np.array([0, 1, 2] * 4000)
    assert periodic._document_runs([w]) == [[(0, 12000, 3)]]
    assert len(compared) == 2  # once to the left, once to the right


def test_query_of_periods(spark, tmp_path):
    rng = random.Random(4)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12] + [1, 2, 3]
    docs = [(i, " \n".join(rng.choice("abcdef") * rng.randint(1, 3) for _ in range(rng.randint(0, 130)))) for i in ids]
    docs += [(None, "a " * 30), (5, None), (ids[0], docs[0][1])]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for i, t in docs:
        w = words(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            a = (h // 10) % len(w)
            p = 1 + (len(w) - a) // (3 + (h // 10) % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        runs = brute_runs(w)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        milli = 1000 * top[1] // top[2] if runs else None
        want[(i, len(runs), *top, milli, *(hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept)))] += 1
    assert Counter(tuple(r) for r in queries.op11_periodic(spark, str(tmp_path)).collect()) == want


# -- languages ---------------------------------------------------------------------------------


def talk(language: int, n: int, rng) -> str:
    parts = [["ka", "to", "mi", "ra"], ["sch", "en", "ung", "er"], ["é", "ou", "le", "ça"]][language]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


class Plain:
    """The same model with dictionaries and probabilities, symbol by symbol."""

    def __init__(self, texts, order, least):
        self.order, counts = order, Counter()
        for t in texts:
            for w in words(t):
                s = b" " + w + b" "
                for i in range(1, len(s)):
                    for d in range(min(order, i) + 1):
                        counts[s[i - d : i + 1]] += 1
        self.total = sum(n for g, n in counts.items() if len(g) == 1)
        self.counts = {g: n for g, n in counts.items() if n >= least(self.total)}
        self.children = defaultdict(dict)
        for g, n in self.counts.items():
            self.children[g[:-1]][g[-1:]] = n

    def chance(self, context: bytes, symbol: bytes) -> float:
        own = self.children.get(context, {})
        lower = (lambda s: self.chance(context[1:], s)) if context else (lambda s: 1 / 256)
        if not own:
            return lower(symbol)
        mass = (self.counts[context] if context else self.total) + len(own)
        if symbol in own:
            return own[symbol] / mass
        return (mass - sum(own.values())) / mass * lower(symbol) / (1 - sum(lower(s) for s in own))

    def bits(self, text: str) -> float:
        total = 0.0
        for w in words(text):
            s = b" " + w + b" "
            for i in range(1, len(s)):
                total -= math.log2(self.chance(s[max(0, i - self.order) : i], s[i : i + 1]))
        return total


@pytest.mark.parametrize(("order", "nodes"), [(4, 1 << 17), (2, 64), (0, 1 << 17)])
def test_code_lengths(spark, order, nodes):
    rng = random.Random(5)
    learning = [(talk(k % 3, 12, rng), "abc"[k % 3]) for k in range(30)]
    learning += [(None, "a"), ("", "b"), ("x", None), ("  ", "void"), (learning[0][0], "a")]
    trees = langid.learn(spark.createDataFrame(learning, "text string, lang string").repartition(3), order, nodes)
    assert trees.languages == ("a", "b", "c")
    assert max(len(g) for g in trees.grams) <= nodes
    plain = [Plain([t for t, k in learning if k == lang and t], order, lambda n: max(1, n * 3 / nodes)) for lang in "abc"]
    for model in plain[:1]:  # probabilities add up to one in every context
        for context in [b"", *list(model.children)[:40]]:
            assert sum(model.chance(context, bytes([x])) for x in range(256)) == pytest.approx(1, abs=1e-9)
    texts = [talk(k, 9, rng) for k in (0, 1, 2)] + ["new\tWords\n", "é", "katomi " * 700, "zq" * 40, "1 2 3", "..", "", None, "katomi"]
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[1])]
    got = {}
    for r in langid.predict(frame(spark, rows), trees).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"], r["bits"]))
    assert sum(map(len, got.values())) == len(rows)
    for i, t in rows:
        for label, score, bits in got[i]:
            if t is None or not any(c.isalpha() for c in t):
                assert (label, score, bits) == ("und", 0.0, None)
                continue
            want = [m.bits(t) for m in plain]
            assert bits == pytest.approx(want, rel=1e-4, abs=0.01)
            if order == 4 and i is not None and i < 3:
                assert label == "abc"[i]
            best = min(bits)
            assert score == pytest.approx(1 / sum(2.0 ** -(b - best) for b in bits), rel=1e-6)
    assert got[0][0] == got[0][1]


def test_languages_without_learning(spark):
    trees = langid.learn(spark.createDataFrame([(None, None)], "text string, lang string"))
    assert langid.predict(frame(spark, [(1, "some text"), (2, None)]), trees).select("lang_pred", "score").distinct().collect() == [
        ("und", 0.0)
    ]
    assert langid.predict(frame(spark, []), trees).count() == 0
    with pytest.raises(ValueError):
        langid.learn(spark.createDataFrame([("w", f"l{i}") for i in range(201)], "text string, lang string"))
    same = langid.learn(spark.createDataFrame([("tie here", "b"), ("tie here", "a")], "text string, lang string"))
    assert langid.predict(frame(spark, [(1, "tie")]), same).first()["lang_pred"] == "a"


def test_languages_held_out(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op12_langid(spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    held_out = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and 200 < len(held_out) < 300
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held_out) >= 0.98 * len(held_out)


# -- turns -------------------------------------------------------------------------------------

GOAL = re.compile(r"(s?(ua)+)?")


def best_edits(rows: list[tuple[str, str]]) -> tuple[dict, int, str, list[str]]:
    """By dynamic programming over (rows done, state) with whole strings."""
    faults, seen = [], set()
    for role, text in rows:
        solid = text.strip(" \t\n\r\x0b\x0c")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    ways = {0: (0, "", [])}

    def inserted(ways):
        out = dict(ways)
        for _ in range(3):
            for state, (cost, audit, made) in list(out.items()):
                role, after = ("assistant", 3) if state == 2 else ("user", 2)
                way = (cost + 2, audit + "I", [*made, f"{role}:"])
                out[after] = min(out.get(after, way), way)
        return out

    for (role, text), fault in zip(rows, faults):
        step = {}

        def offer(state, way):
            step[state] = min(step.get(state, way), way)

        for state, (cost, audit, made) in inserted(ways).items():
            offer(state, (cost + 3, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            extra = int(fault == "truncated")
            want, after = ("assistant", 3) if state == 2 else ("user", 2)
            if role[:1] == want[:1]:
                offer(after, (cost + extra, audit + "K", [*made, f"{role}:{text}"]))
            else:
                offer(after, (cost + 2 + extra, audit + "R", [*made, f"{want}:{text}"]))
            if role[:1] == "s" and state == 0:
                offer(1, (cost + extra, audit + "K", [*made, f"{role}:{text}"]))
        ways = step
    ends = inserted(ways)
    cost, audit, made = min(ends[s] for s in (0, 3) if s in ends)
    assert GOAL.fullmatch("".join(m[0] for m in made))
    return Counter(faults), cost, audit, made


def brute_repair(rows: list[tuple]) -> dict:
    """Result per conversation of (conv_id, turn, role, text, present)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x, p in rows if c == conv and p]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, cost, audit, made = best_edits([r[1:] for r in own])
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)
    return out


def random_rows(rng, conv, n) -> list[tuple]:
    texts = ["Yes.", "No!", "cut", "", " \n", "Why?  ", "x", None, "Same.", "Ça va?"]
    roles = ["user", "assistant", "system", "tool", "", None, "s", "usher"]
    rows = []
    for k in range(n):
        text = rng.choice(texts) if rng.random() < 0.3 else f"Line {rng.randint(0, 3 * n)}."
        role = ["user", "assistant"][k % 2] if rng.random() < 0.8 else rng.choice(roles)
        turn = None if rng.random() < 0.05 else k + (k > 4) * 3 - (rng.random() < 0.1)
        rows.append((conv, turn, role, text, rng.random() > 0.1))
    return rows


def turn_rows() -> list[tuple]:
    rng = random.Random(6)
    rows = [r for c in range(120) for r in random_rows(rng, c, rng.randint(1, 14))]
    rows += random_rows(rng, 200, 150) + random_rows(rng, None, 9)
    rows += [(300, 0, "user", "Gone.", False), (301, None, "user", "a", True)]
    rows += [(302, 5, "user", "Same.", True)] * 7
    return rows


def as_frame(spark, rows, parts=5):
    schema = "conv_id long, turn int, role string, text string, present boolean, part string, cost string, fresh string"
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema).repartition(parts)


@pytest.mark.parametrize("piece", [8192, 7])
def test_repair(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rows = turn_rows()
    pieces = conversations.repair(as_frame(spark, rows))
    got = {r[0]: tuple(r)[1:] for r in conversations.summaries(pieces).collect()}
    assert got == brute_repair(rows)
    assert pieces.where("not whole").count() > 4 and pieces.where("whole").count() > 4


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 50)
    rng = random.Random(8)
    rows = random_rows(rng, 1, 1500) + [(2, 0, "user", "Hi.", True), (2, 1, "assistant", "Ho.", True)]
    pieces = conversations.repair(as_frame(spark, rows))
    assert pieces.where("conv_id = 1").select("part").distinct().count() > 1
    got = {r[0]: tuple(r)[1:] for r in conversations.summaries(pieces).collect()}
    assert got == brute_repair(rows)


def test_no_conversations(spark):
    assert conversations.summaries(conversations.repair(as_frame(spark, []))).count() == 0
    gone = conversations.summaries(conversations.repair(as_frame(spark, [(1, 0, "user", "x.", False)]))).collect()
    assert [tuple(r) for r in gone] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_auction_against_all_strings():
    """Least cost and least string over all edits up to two inserts between rows, for every short sequence of signs."""
    for signs in itertools.chain.from_iterable(itertools.product("suaxSUAX-", repeat=n) for n in range(4)):
        best = {}
        ways = [(0, "", 0)]
        for sign in [*signs, None]:
            wider = []
            for cost, audit, state in ways:
                for _ in range(3):
                    wider.append((cost, audit, state))
                    cost, audit, state = cost + 2, audit + "I", conversations.ACCEPTS[state][1]
            if sign is None:
                best = min(w[:2] for w in wider if w[2] in (conversations.NOTHING, conversations.AFTER_A))
                break
            ways = []
            for cost, audit, state in wider:
                role, after = conversations.ACCEPTS[state]
                ways.append((cost + 3, audit + "D", state))
                if sign != "-":
                    kept = sign.lower() == role
                    ways.append((cost + (0 if kept else 2) + sign.isupper(), audit + "RK"[kept], after))
                    if sign in "sS" and state == conversations.NOTHING:
                        ways.append((cost + sign.isupper(), audit + "K", conversations.AFTER_S))
        assert conversations.whole("".join(signs)) == best


def test_stretches_agree_with_one_lattice():
    rng = random.Random(9)
    for _ in range(40):
        signs = "".join(rng.choice("suaxUA-uaua") for _ in range(rng.randint(33, 100)))
        target = 4 * len(signs) + 4
        assert conversations.edits(signs, 0, conversations.CLOSED) == conversations.cheapest(signs, True, (0,), target)[0]


def test_prices_are_dual_feasible_and_tight():
    arcs, n = conversations.arcs_of("suxA-uaa", True)
    prices = [0] * n
    target = n - 1
    alive = conversations.leading(arcs, target)
    arcs = [[a for a in own if a[2] in alive] if i in alive else [] for i, own in enumerate(arcs)]
    conversations.auction(arcs, 0, target, prices)
    assert all(prices[i] <= cost + prices[j] for i, own in enumerate(arcs) for cost, _, j in own)
    assert prices[0] == conversations.whole("suxA-uaa")[0] and prices[target] == 0
