from __future__ import annotations

import random

import numpy as np

from tallyline.llm.decontaminate import Settings, _common, _pieces, _ready, _sharing, item_passages, leaks, weights, without_leaks

BENCH = "item_id long, text string"
SYLLABLES = "ka lo mi ren tu sha vel por din az che bru".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(2, 5)))


def prose(rng, n):
    common = ["the", "of", "and", "in", "to", "a"]
    return [rng.choice(common) if rng.random() < 0.4 else word(rng) for _ in range(n)]


def items(rng, n=25):
    out = []
    for i in range(n):
        words = prose(rng, rng.randrange(15, 55))
        cut = len(words) - rng.randrange(4, 8)
        out.append((i, " ".join(words[:cut]).capitalize() + ". " + " ".join(words[cut:]).capitalize() + "."))
    return out


def planted(rng, bench, n=150):
    """(rows, pairs that must be found): copies, paraphrases with the answer kept, and clean documents."""
    rows, pairs = [], set()
    for doc in range(n):
        words = prose(rng, rng.randrange(0, 300))
        if doc % 3 == 0:
            item, text = rng.choice(bench)
            own = text.split()
            if doc % 6 == 0:
                for at in rng.sample(range(int(len(own) * 0.6)), int(len(own) * 0.12)):
                    own[at] = word(rng)
                own = [w.upper() for w in own]
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
            pairs.add((doc, item))
        rows.append((doc, " ".join(words)))
    return rows, pairs


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_finds_copies_and_paraphrases_and_nothing_else(spark, docs):
    rng = random.Random(4)
    bench = items(rng)
    rows, pairs = planted(rng, bench)
    got = leaks(docs(rows).repartition(5), spark.createDataFrame(bench, BENCH)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == pairs
    assert all(r["lcs"] == 1.0 and r["answer"] == 1.0 for r in got if r["doc_id"] % 6)
    assert all(0.65 <= r["lcs"] <= 1 and r["cosine"] >= 0.4 for r in got)


def test_finds_what_no_cosine_finds(spark, docs):
    rng = random.Random(8)
    bench = items(rng)
    rows, pairs = planted(rng, bench)
    for doc in range(200, 230):  # paraphrases: every fourth word of the head is another, the answer is kept
        item, text = rng.choice(bench)
        own = text.split()
        head = len(own) - next(n for n in range(4, 9) if own[-n - 1].endswith("."))
        own[:head] = [word(rng) if i % 4 == 1 else w for i, w in enumerate(own[:head])]
        rows.append((doc, " ".join(prose(rng, rng.randrange(90)) + own + prose(rng, 40))))
        pairs.add((doc, item))
    got = leaks(docs(rows), spark.createDataFrame(bench, BENCH), Settings(cosine=2.0)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == pairs


def test_every_stretch_that_can_be_a_leak_is_a_candidate():
    rng = random.Random(9)
    settings = Settings()
    bench = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(8, 60)))) for i in range(30)]
    passages, vocabulary = item_passages(bench, settings)
    counts = np.array([10**6, *(rng.randrange(1, 10**5) for _ in vocabulary)])
    ready = _ready(passages, np.zeros((len(counts), 1), np.float32), counts, settings)
    texts = []
    for _ in range(25):
        own = []
        while rng.random() < 0.7:
            own += [w if rng.random() < 0.8 else rng.randrange(len(counts)) for w in rng.choice(passages).words.tolist() if rng.random() < 0.95]
            own += [rng.randrange(len(counts)) * (rng.random() < 0.3) for _ in range(rng.randrange(50))]
        texts.append([*own, 0])
    words, firsts = np.array(sum(texts, []), np.int32), np.cumsum([0, *map(len, texts)])
    starts, of = _pieces(len(words), firsts[:-1], settings.chunk)
    found = set(zip(*(x.tolist() for x in _sharing(ready.local[words], starts, of, ready.rare, settings)), strict=True))
    wanted = set()
    for n, (start, text) in enumerate(zip(starts, of, strict=True)):
        low, high = max(start - settings.chunk, firsts[text]), min(start + settings.window + settings.chunk, firsts[text + 1])
        near = words[low:high].tolist()
        wanted |= {(n, i) for i, p in enumerate(passages) if lcs(near, p.words.tolist()) >= settings.reworded * len(p.words)}
    assert len(wanted) > 100 and wanted <= found


def test_same_pairs_for_blocks_of_the_benchmark(spark, docs):
    rng = random.Random(5)
    bench = items(rng, 12)
    rows, pairs = planted(rng, bench, 60)
    got = leaks(docs(rows), spark.createDataFrame(bench, BENCH), Settings(passages_at_once=4)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == pairs


def test_an_answer_elsewhere_is_no_leak(spark, docs):
    rng = random.Random(6)
    bench = items(rng, 6)
    rows = []
    for item, text in bench:  # only the answer, or only a third of the item
        own = text.split()
        rows.append((2 * item, " ".join(prose(rng, 50) + own[-4:] + prose(rng, 50))))
        rows.append((2 * item + 1, " ".join(prose(rng, 50) + own[: len(own) // 3] + prose(rng, 50))))
    assert leaks(docs(rows), spark.createDataFrame(bench, BENCH)).collect() == []


def test_odd_rows(spark, docs, clashing):
    rng = random.Random(7)
    bench = [*items(rng, 5), (50, None), (51, ""), (None, "an item without an id of many words"), (52, "..."), (53, "solo"), (0, items(random.Random(7), 1)[0][1])]
    text = bench[1][1]
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "a " * 70_000 + text), (5, "only " * 10), (6, "..")]
    frame = clashing(docs(rows))
    got = {(r["doc_id"], r["item_id"]) for r in leaks(frame, spark.createDataFrame(bench, BENCH)).collect()}
    assert got == {(3, 1), (4, 1)}
    kept = without_leaks(frame, spark.createDataFrame(bench, BENCH))
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "5", "6", "None"]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], BENCH)
    assert leaks(docs([(1, "a b c")]), none).collect() == []
    assert leaks(docs([]), spark.createDataFrame([(1, "a b c d")], BENCH)).collect() == []
    assert [r["doc_id"] for r in without_leaks(docs([(1, "a")]), none).collect()] == [1]


def test_bit_parallel_lcs_equals_the_table():
    rng = np.random.default_rng(1)
    for _ in range(60):
        size = int(rng.integers(1, 33))
        item, text = rng.integers(0, 6, size), rng.integers(0, 6, int(rng.integers(0, 80)))
        masks = np.array([[sum(1 << i for i, w in enumerate(item.tolist()) if w == t)] for t in text.tolist()], np.uint32).reshape(-1, 1)
        assert _common(masks, np.array([size]))[0] == lcs(item.tolist(), text.tolist())


def test_common_words_weigh_nothing_unless_nothing_is_left():
    passages, vocabulary = item_passages([(1, "the red fox ran over five hills today"), (2, "the the the of")], Settings())
    counts = np.full(len(vocabulary) + 1, 1)
    counts[0] = 1000
    counts[vocabulary[b"the"]] = counts[vocabulary[b"red"]] = 900
    weight = weights(counts, passages, Settings())
    assert weight[vocabulary[b"red"]] == 0 and weight[vocabulary[b"the"]] > 0 and weight[vocabulary[b"fox"]] > 1
