"""The text operators against brute force on small tables with nulls, ties, repeats, long texts and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from carelattice.llm import decontamination, exact, jaccard, katz, packing, quality, substrings, token_files, toxicity, warc
from carelattice.llm.common import documents
from carelattice.llm.features import STATS
from carelattice.llm.tokens import Encoder, default_path

SPACES = re.compile(rb"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, norm string, block int, n long, key string"


def words(text: str | None) -> list[bytes]:
    return [w for w in SPACES.split((text or "").encode()) if w]


def rows() -> list[tuple]:
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = text(30), text(60)
    texts = [text(rng.randint(0, 80)) for _ in range(40)]
    texts += [None, "", " ", "\n\t ", "one", "ONE", "two words", "ünï çode  spaces", "a " * 45, "a b " * 30, text(3000)]
    texts += [f"{text(9)} {passage} {text(5)}" for _ in range(5)] + [passage, passage.replace(" ", "\n")]
    near = base.split()
    for i in range(8):
        near[10 + 5 * (i % 3)] = rng.choice(vocabulary)
        texts.append(" ".join(near))
    out = [(i, t, "en", None, None, "x", 1, 2, "k") for i, t in enumerate(texts)]
    return out + [out[3], out[3], (None, texts[5], *out[0][2:]), (None, None, *out[0][2:])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_exact_groups(docs, none):
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[SPACES.sub(b" ", (t or "").encode())].append(i)
    want = Counter()
    for text, ids in groups.items():
        keep = min(ids, key=lambda i: (i is not None, i or 0))
        for i in ids:
            want[(i, keep, len(ids), i == keep, hashlib.sha256(text).hexdigest())] += 1
    assert got(exact.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert exact.keep_first(docs).count() == len(groups)
    assert exact.keep_first(docs).columns == docs.columns
    assert exact.exact_groups(none).count() == 0 and exact.keep_first(none).count() == 0


def test_texts_that_share_a_digest_stay_apart(docs, monkeypatch):
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[SPACES.sub(b" ", (t or "").encode())].append(i)
    want = Counter()
    for ids in groups.values():
        keep = min(ids, key=lambda i: (i is not None, i or 0))
        want.update((i, keep, len(ids), i == keep) for i in ids)
    whole = exact.digests
    weak = F.concat(F.lpad((F.length("norm") % 2).cast("string"), 15, "0"), F.lit("0"))
    monkeypatch.setattr(exact, "digests", lambda d: whole(d).withColumn("sha", weak))
    assert got(exact.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept") == want


def test_fuse_filter():
    rng = np.random.default_rng(1)
    for n in (1, 2, 10, 1000, 30_000):
        keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
        data = exact.build_filter(keys)
        assert exact.in_filter(data, keys).all()
        assert exact.in_filter(data, rng.integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.01
    assert len(data) * 8 < 12 * 30_000
    assert not exact.in_filter(exact.build_filter(np.empty(0, np.uint64)), keys).any()


def test_repeated_passages(docs, none):
    seen, want = set(), Counter()
    for i, t, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        own = words(t)
        gone = [False] * len(own)
        for j in range(len(own) - 19):
            window = tuple(own[j : j + 20])
            if window in seen:
                gone[j : j + 20] = [True] * 20
            seen.add(window)
        want[(i, len(own), sum(gone), b" ".join(w for w, g in zip(own, gone) if not g))] += 1
    for heavy in (20_000, 1):  # the second sends every repeated window by all its words
        cut = substrings.remove_repeats(docs, heavy=heavy)
        found = Counter((r[0], r[1], r[2], bytes(r[3])) for r in cut.select("doc_id", "n_words", "n_removed", "kept").collect())
        assert found == want
    assert substrings.remove_repeats(none).count() == 0


def test_jaccard_components(docs, none):
    sets = []
    for i, t, *_ in rows():
        own = words((t or "").lower())
        grams = {tuple(own[j : j + 5]) for j in range(len(own) - 4)} or ({tuple(own)} if own else set())
        sets.append((i, grams))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    members = defaultdict(list)
    for a, (i, _) in enumerate(sets):
        members[find(a)].append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    want = Counter((i, len(x), least[find(a)] if x else i) for a, (i, x) in enumerate(sets))
    assert got(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == want
    assert jaccard.jaccard_components(none).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_katz(docs, none, order):
    flagged = docs.selectExpr("doc_id", "text", "doc_id % 3 <> 0 training", "norm")
    corpus = [(i, words((t or "").lower()), i is not None and i % 3 != 0) for i, t, *_ in rows()]
    start, end = b"\0<s>", b"\0</s>"
    counts = [Counter() for _ in range(order + 1)]
    padded = [([start] * (order - 1) + w + [end], i, train) for i, w, train in corpus]
    for seq, _, train in padded:
        for j in range(order - 1, len(seq) if train else 0):
            for n in range(1, order + 1):
                counts[n][tuple(seq[j - n + 1 : j + 1])] += 1
    total, k = sum(counts[1].values()), katz.KEEP
    d = [None] + [katz.Discounts.of(np.array([sum(v == r for v in c.values()) for r in range(1, k + 2)])).d for c in counts[1:]]
    after = defaultdict(list)
    for c in counts[2:]:
        for gram, v in c.items():
            after[gram[:-1]].append((gram[-1], v))
    less = lambda n, c: (d[n][c] if c <= k else 1) * c
    free = sum((1 - d[1][v]) * v for v in counts[1].values() if v <= k)

    def size(h):
        return sum(v for _, v in after[h]) + (not any(v <= k for _, v in after[h]))

    def p(h, w):
        if not h:
            c = counts[1].get((w,), 0)
            return (less(1, c) or free) / total
        if h not in after:
            return p(h[1:], w)
        c = counts[len(h) + 1].get((*h, w), 0)
        if c:
            return less(len(h) + 1, c) / size(h)
        seen = sum(less(len(h) + 1, v) for _, v in after[h]) / size(h)
        return (1 - seen) / (1 - sum(p(h[1:], x) for x, _ in after[h])) * p(h[1:], w)

    want = defaultdict(list)
    for seq, i, _ in padded:
        want[i].append(sum(math.log10(p(tuple(seq[j - order + 1 : j]), seq[j])) for j in range(order - 1, len(seq))))
    for some in sorted((h for h in after if len(h) == order - 1), key=lambda h: -size(h))[:25]:
        mass = sum(p(some, w) for (w,) in counts[1]) + p(some, b"never seen")
        assert abs(mass - 1) < 1e-9
    spark = docs.sparkSession
    for n in (1, 4, 16):  # the more buckets, the more contexts count as hot
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            scored = katz.katz_scores(flagged, order).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        found = defaultdict(list)
        for r in scored:
            found[r["doc_id"]].append(r["score"])
            assert r["train_tokens"] == total
        assert found.keys() == want.keys()
        assert all(np.allclose(sorted(found[i]), sorted(want[i]), atol=1e-8) for i in want)
    assert katz.katz_scores(none.selectExpr("doc_id", "text", "true training")).count() == 0


def test_encoder_equals_whole_tokenizer():
    rng = random.Random(3)
    letters = list("aAbz's.,  \n\n\t1²éÈßΣςİ́  \x1c\x85ñ日ⅷ|<>_-'t") + ["<|endoftext|>", "'ll"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = Encoder(default_path(name))
        for _ in range(3000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
            assert encoder.encode(text) == encoder._whole(text)


def test_encoder_equals_untouched_tokenizer():
    rng = random.Random(5)
    letters = [*"aAz's.  \n\t1²éΣς\x1c\xa0日|<>", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext"]
    for name, ids in (("word_bpe_49k.json", [23435, 49407, 2411]), ("byte_bpe_50k.json", [21943, 220, 50256, 2318])):
        encoder, untouched = Encoder(default_path(name)), Tokenizer.from_file(default_path(name))
        told = ["foo <|endoftext|> bar", *("".join(rng.choices(letters, k=rng.randint(0, 20))) for _ in range(3000))]
        for text in told:
            want = untouched.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == want
        assert untouched.encode(told[0], add_special_tokens=False).ids == ids


def test_elias_fano():
    rng = np.random.default_rng(5)
    for n, bound in ((1, 1), (1, 10**6), (300, 300), (300, 10**6), (5000, 20_000)):
        values = np.sort(rng.integers(1, bound + 1, n))
        ef = token_files.EliasFano.of(values)
        assert (ef.all() == values).all()
        assert [ef.select(i) for i in range(n)] == values.tolist()


def test_token_files_round_trip(docs, none):
    vocabulary = default_path("byte_bpe_50k.json")
    encoder = Encoder(vocabulary)
    for segment in (1 << 20, 100):
        files = token_files.write_token_files(docs, vocabulary, 2, segment, 50_257)
        found = sorted(token_files.read_spans(files).collect(), key=lambda r: r["start"])
        texts = {(i, zlib.crc32(e), len(e) // 4) for i, t, *_ in rows() if (e := encoder._whole(t or "") + (2).to_bytes(4, "little"))}
        assert {(r["doc_id"], r["ids_crc32"], r["n_tokens"]) for r in found} == texts
        assert len(found) == len(rows())
        assert [r["start"] for r in found[1:]] == np.cumsum([r["n_tokens"] for r in found])[:-1].tolist()
        ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
        assert ids == sorted(ids)
    assert token_files.read_spans(token_files.write_token_files(none, vocabulary, 2)).count() == 0


def test_packing(docs, none):
    vocabulary, capacity = default_path("word_bpe_49k.json"), 128
    found = packing.pack_documents(docs, vocabulary, capacity=capacity, group_pieces=40).collect()
    encoder = Encoder(vocabulary)
    want = Counter()
    for i, t, *_ in rows():
        data = encoder._whole(t or "") + bytes(4)
        for piece, at in enumerate(range(0, len(data), 4 * capacity)):
            part = data[at : at + 4 * capacity]
            want[(i, piece, at // 4, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= 1.25 * sum(r["length"] for r in found) / capacity + 2
    assert packing.pack_documents(none, vocabulary).count() == 0


def test_crossover_keeps_every_piece():
    rng = random.Random(2)
    lengths = [rng.randint(1, 100) for _ in range(200)]
    order = sorted(range(200), key=lambda i: -lengths[i])
    a, b = (packing._shaken(order, lengths, 100, rng) for _ in range(2))
    child = packing._crossover(a, b, lengths, 100, rng)
    assert sorted(i for c in child for i in c) == list(range(200))
    assert all(sum(lengths[i] for i in c) <= 100 for c in child)


def test_template_matches(spark, docs, none):
    item = "Alice runs to meet Bob Jones who walked 12 km in 3 hours and then carried 40 kg of flour home for dinner"
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short"), (None, "")], "item_id long, text string")
    told = [
        (1, "Intro. " + item + " More."),
        (2, item.replace("12", "19").replace("Bob Jones", "Eve Smith").replace("40", "7")),
        (3, "Nothing of the kind stands here, only other words that go on and on for a while"),
        (4, None),
    ]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in told], "doc_id long, text string, row string, item_id string")
    found = {r["doc_id"]: r for r in decontamination.benchmark_matches(frame, items).collect()}
    assert sorted(found) == [1, 2]
    assert found[1]["changed_slots"] == 0 and found[2]["changed_slots"] >= 3
    assert [r[0] for r in decontamination.keep_uncontaminated(frame, items).select("doc_id").collect()] in ([3, 4], [4, 3])
    # One value of the item cannot stand for two of the document.
    twice = "so Carl Brown gave 5 apples to a friend and later Carl Brown gave 5 pears to another friend of the house"
    index = decontamination.Benchmark([(1, twice.encode())], 8, 5)
    assert index.matches(twice.replace("5", "9").encode().split())[0][1] > 15
    mixed = twice.replace("5", "9", 1).replace("5", "8").encode().split()
    assert all(m[1] < 15 for m in index.matches(mixed))
    assert decontamination.benchmark_matches(docs, items.limit(0)).count() == 0
    assert decontamination.benchmark_matches(none, items).count() == 0


def test_a_contradicting_slot_cuts_the_match():
    long = " ".join(f"plain{i} words{i} here{i} Anna Smith then{i}" if i in (1, 4, 8) else f"more{i} words{i} come{i}" for i in range(10))
    index = decontamination.Benchmark([(1, long.encode())], 8, 5)
    at = long.index("Anna", long.index("Anna") + 1)
    for wrong in (long[:at] + "Anma" + long[at + 4 :], long.replace("Anna", "Anma", 1)):
        assert max(m[1] for m in index.matches(wrong.encode().split())) >= 20
    two = "so then the farmer sold 5 apples and 7 pears to a friend who came by"
    index = decontamination.Benchmark([(1, two.encode())], 8, 5)
    assert index.matches(two.replace("5", "4").replace("7", "4").encode().split()) == [(0, 16, 16, 2, 2)]
    index = decontamination.Benchmark([(1, two.replace("7", "5").encode())], 8, 5)
    assert index.matches(two.encode().split())[0][1] >= 8


def test_verbatim_copies_without_literal_words():
    items = ["3 + 4 = 7 and 12 - 5 = 7", "Anna Bob Carl Dora Emil Fritz Gina Hans Ida", "The Old Man And The Sea Is A Book", "Why Paris", "== ## =="]
    items.append("Which river runs through the town")
    index = decontamination.Benchmark([(i, t.encode()) for i, t in enumerate(items)], 8, 5)
    for i, item in enumerate(items):
        n = len(item.split())
        for text in (item, f"A heading\n{item} more", f"some {item.upper()}", item.lower()):
            assert (i, n, n) in [m[:3] for m in index.matches(text.encode().split())]
    assert index.matches(b"") == [] and index.matches_of([b"Why".split(), b"Paris".split()]) == [[], []]
    # With one window only, a changed number after a heading.
    index = decontamination.Benchmark([(1, b"Which river runs 7 miles through the town")], 8, 5)
    assert index.matches(b"A heading Which river runs 9 miles through the town".split())[0][1:3] == (8, 8)


def test_changes_of_length_divide_no_match():
    item = "a man walks from Paris to the old mill and back in 3 hours while his dog runs 12 km with no rest at all on the way"
    index = decontamination.Benchmark([(1, item.encode())], 8, 5)
    n = len(item.split())
    told = item.replace("Paris", "New York").replace("12 km", "15km").replace("3 hours", "4h")
    assert index.matches(told.encode().split())[0] == (0, n, n, 3, 3)
    parts = [" ".join(f"{c}{i}" for i in range(10)) for c in "xyz"]
    index = decontamination.Benchmark([(1, " ".join(parts).encode())], 8, 5)
    for text in (" added ".join(parts), " ".join(p[: p.rindex(" ")] for p in parts)):
        assert index.matches(text.encode().split())[0][1] >= 27


def test_fixity_audit(spark):
    schema = "page_id long, url string, html string, digest string, node long"
    first = [(i, f"http://x/{i}", "b" * (i % 50), "d", 1) for i in range(3000)] + [(7, None, None, None, None), (None, "u", "h", None, None)]
    damaged = {5: "corrupt", 17: "missing", 2900: "missing", 2901: "corrupt", 5000: "extra"}
    second = [(i, u, h + "!" if damaged.get(i) == "corrupt" else h, *x) for i, u, h, *x in first[:3000] if damaged.get(i) != "missing"]
    second += [first[3000], (5000, "new", "page", None, None)]
    one, two = (spark.createDataFrame(r, schema) for r in (first, second))
    found = {r["number"]: r["status"] for r in warc.audit(one, two).collect()}
    assert found == {**damaged, None: "unnumbered in first"}
    assert warc.audit(one.where("page_id is not null"), one.where("page_id is not null")).count() == 0
    assert warc.audit(one.limit(0), one.limit(0)).count() == 0
    assert warc.audit(one.limit(0), two).where("status = 'extra'").count() == two.select("page_id").distinct().count()


def labelled(spark):
    rng = random.Random(4)
    plain = ["river", "stone", "the", "of", "green", "walk", "light", "and", "winter", "paper"]
    made, labels = [], []
    for i in range(400):
        own = [rng.choice(plain) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(20, 60))]
        toxic, poor = i % 9 == 0, i % 6 == 1
        if toxic:
            own[rng.randrange(len(own))] = rng.choice(["grumblefoot", "Zankhead,", "idiot"])
        if poor:
            own = [w + rng.choice(["%%%", "$$$", "&&&"]) for w in own]
        made.append((i, " ".join(own), "x"))
        labels.append((i, int(not poor), int(toxic)))
    made += [(None, None, None), (400, "", "x"), (401, None, "x"), made[0]]
    labels += [(None, 1, 1), (3, None, None), labels[2]]
    docs = spark.createDataFrame(made, "doc_id long, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_votes_are_those_of_plain_python(spark):
    texts = [
        "", " ", "you are an IDIOT", " your a b c moron", "you a b c d moron", "AAB cde", "STOP THIS NOW", "STOP, THIS! NOW x",
        "AB ABC ABCD\u00e9 EFG", "wow!!!", "what?!?!", "what?!", "\tgrue\x0bidiots \u00a0 you're\u2003trash,", "you", "idiot " * 500,
    ]
    masks = toxicity.voter_masks([b"grue", b"idiot*", b"you"])

    def plain(body: bytes) -> int:
        words, fired = body.split(), 0
        for i, w in enumerate(words):
            own = [masks[f] for f in toxicity.forms(w) if f in masks]
            for m in own:
                fired |= m
            if own and any(toxicity.bare(x) in (b"you", b"your", b"youre", b"you're") for x in words[max(0, i - 4) : i]):
                fired |= 1 << toxicity.VOTERS.index("you_insult")
        shouted = re.search(rb"\b[A-Z]{3,}\b(?:\W+[A-Z]{3,}\b){2}", body)
        marked = re.search(rb"!{3,}|[!?]{4,}", body)
        return fired | bool(shouted) << toxicity.VOTERS.index("shouting") | bool(marked) << toxicity.VOTERS.index("marks")

    bodies = [t.encode() for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(bodies, pa.binary())], ["text"])
    for piece in (toxicity.PIECE_BYTES, 8):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(toxicity, "PIECE_BYTES", piece)
            pieces = list(toxicity._pieces(batch, toxicity._Memory(masks, {b"moron": 0, b"trash": 1, b"idiot": 2})))
        assert [v for p in pieces for v in toxicity.votes_of(p).tolist()] == [plain(b) for b in bodies]
        values = [set(v.tolist()) for p in pieces for t, v in [p.pairs(3)] for v in np.split(v, np.searchsorted(t, np.arange(1, len(p.bodies))))]
        assert values == [{n for n, w in enumerate(("moron", "trash", "idiot")) if w in toxicity_words(b)} for b in bodies]


def toxicity_words(body: bytes) -> set[str]:
    return {toxicity.bare(w).decode() for w in body.split()}


def test_toxicity_leaves_texts_without_label_out_before_the_join(spark):
    docs = spark.range(5000).selectExpr("if(id = 7, null, id) doc_id", "cast(id as string) text")
    labels = spark.range(0, 5000, 50).selectExpr("id doc_id", "cast(id % 2 as int) toxic")
    kept = {r[0] for r in toxicity._maybe_labelled(docs, toxicity._one_label(labels)).select("doc_id").collect()}
    assert set(range(0, 5000, 50)) <= kept and len(kept) < 600


def test_toxicity_and_quality(spark, none):
    docs, labels = labelled(spark)
    truth = {r[0]: (r[1], r[2]) for r in labels.collect() if r[0] is not None and r[1] is not None}
    classifier, model = toxicity.learn(docs, quality.training_labels(labels, "toxic"))
    scores = [(r["doc_id"], r["score"]) for r in toxicity.score_toxicity(docs, classifier).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for _, s in scores)
    assert np.mean([(s >= 0.5) == (truth[i][1] == 1) for i, s in scores if i in truth and i < 400]) > 0.97
    assert len(model.factors) and {v for f in model.factors for v in f} == set(range(len(toxicity.VOTERS)))
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.where("text is null").count() == 2

    fitted = quality.learn(docs, quality.training_labels(labels, "quality"))
    scores = [(r["doc_id"], r["score"]) for r in quality.score_quality(docs, fitted).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for _, s in scores)
    assert np.mean([(s >= 0.3) == (truth[i][0] == 1) for i, s in scores if i in truth and i < 400]) > 0.95
    assert 0.7 < fitted.prior < 0.95
    # Nothing to learn from, nothing to score.
    blank = labels.limit(0)
    assert toxicity.score_toxicity(none, toxicity.learn(none, blank)[0]).count() == 0
    assert quality.score_quality(none, quality.learn(none, blank)).count() == 0
    assert {r["score"] for r in quality.score_quality(docs, quality.learn(docs, blank)).collect()} == {0.5}
    assert fitted.edges.shape[0] == len(STATS)


def test_lexicons_count_all_labelled_rows(spark):
    # 20,000 labelled rows, 0.5 % toxic, marked by ten words of which each is in one toxic text of ten.
    made = [(i, f"the river n{i % 49} walks " + (f"vilemark{chr(97 + i // 200 % 10)}" if i % 200 == 0 else "by light")) for i in range(20_000)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 200 == 0)) for i, _ in made], "doc_id long, toxic int")
    lexicon = toxicity.mine_lexicon(docs, labels)
    assert {f"vilemark{c}".encode() for c in "abcdefghij"} <= set(lexicon)
    assert all(w.startswith(b"vilem"[: len(w.rstrip(b"*"))]) for w in lexicon)
    rows = documents(docs).join(labels, "doc_id")
    assert {r[0]: tuple(r[1:]) for r in toxicity._word_counts(rows).collect()}[b"river"] == (100, 19_900)


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    docs, labels = labelled(spark)
    made = [(i, t, "en", "s", 1) for i, t, _ in docs.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    question = "what number of green apples did the farmer sell in the town when winter came and paper was dear to all"
    made += [(900, made[10][1], "en", "s", 1), (901, f"{made[11][1]} {question}", "en", "s", 1), (902, made[14][1] + " end", "en", "s", 1)]
    spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    clean = {i for i in range(400) if i % 9}
    assert not kept & {900, 901, 902}
    assert len(clean - kept) <= 4 and len([i for i in kept if i < 400 and i % 9 == 0]) <= 2


def test_one_row_of_each_near_copy_stays(spark):
    """Repeated and missing doc_ids, rows that differ in other columns only, and columns named like internal ones."""
    w, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(1, 61))
    far = " ".join(f"v{i}" for i in range(40))
    rows = [(5, w, "a"), (7, w, "b"), (7, near, "c"), (9, near, "d"), (5, w, "e"), (None, w, "f"), (None, far, "g")]
    rows += [(None, far, "h"), (3, "", "i"), (3, None, "j"), (None, "", "k")]
    schema = "doc_id long, text string, __row string"
    clash = spark.createDataFrame([(*r, "1", 2, "3", 4) for r in rows], f"{schema}, __row_0 string, row int, root string, block int")
    kept = jaccard.keep_one(clash.coalesce(1))
    assert kept.columns == clash.columns
    got = sorted((r["doc_id"] or -1, r["text"] or "", r["__row"]) for r in kept.collect())
    assert got == [(-1, "", "k"), (-1, far, "g"), (3, "", "i"), (3, "", "j"), (5, w, "a")]
    assert jaccard.keep_one(clash.limit(0)).count() == 0


def test_exact_copies_with_one_id_collapse_by_their_columns(spark):
    rows = [(4, "a b", "z"), (4, "a\nb", "y"), (4, "a b", None), (6, "a b", "a"), (None, "c", "2"), (None, "c", "1")]
    docs = spark.createDataFrame([(*r, "k", {1: 2}) for r in rows], "doc_id long, text string, lang string, __row_key_0 string, more map<int,int>")
    kept = exact.keep_first(docs.repartition(3))
    assert kept.columns == docs.columns
    # 4 has the smallest id; the text with the line end sorts before the others.
    assert sorted((r["doc_id"] or -1, r["text"], r["lang"]) for r in kept.collect()) == [(-1, "c", "1"), (4, "a\nb", "y")]
