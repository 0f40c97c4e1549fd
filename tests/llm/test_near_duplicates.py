import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import clashing, documents  # noqa: F401
from nightledger.llm import hashing, linking, paragraphs
from nightledger.llm.common import FILE, Scratch, saved
from nightledger.llm.components import components
from nightledger.llm.hashing import shingle_set
from nightledger.llm.hyperminhash import BUCKETS, chance_agreement, near_duplicates, registers
from nightledger.llm.paragraphs import repeated_passages, tune_bands

WORDS = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("a", "e", "i", "o", "u", "an", "er")]


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def reach(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    found = reach(ids, links)
    return sorted((i, len(sets[i]), found[i], found[i] == i) for i in ids)


def edited(random, words, edits):
    words = list(words)
    for _ in range(edits):
        at = random.randrange(len(words))
        kind = random.random()
        if kind < 0.6:
            words[at] = random.choice(WORDS) + "x"
        elif kind < 0.8:
            del words[at]
        else:
            words.insert(at, words[at])
    return words


def corpus(seed=3):
    pick = random.Random(seed)
    rows, line = [], [pick.choice(WORDS) for _ in range(13)]
    for group in range(12):
        base = [pick.choice(WORDS) for _ in range(pick.choice([8, 40, 150, 400]))]
        for _ in range(pick.choice([1, 4, 30])):
            rows.append(" ".join(edited(pick, base, pick.choice([0, 0, 1, 2, 3, 6]))))
    rows += [" ".join(line + [pick.choice(WORDS) for _ in range(60)]) for _ in range(40)]
    rows += ["", None, " \t", "One two", "one TWO", "one two three four five", "É a b c d e", "é a b c d e"]
    pick.shuffle(rows)
    return list(enumerate(rows))


def test_registers_estimate_the_jaccard_similarity():
    values = np.random.default_rng(5)
    for n in (3, 40, 4000):
        for share in (0.5, 0.85):
            agree = []
            for _ in range(60):
                both = values.integers(0, 2**63, n).astype(np.uint64)
                more = max(1, round(n * (1 - share) / share / 2))
                a, b = (np.concatenate([both, values.integers(0, 2**63, more).astype(np.uint64)]) for _ in range(2))
                agree.append((registers(a) == registers(b)).mean())
            estimate = (np.mean(agree) - chance_agreement()) / (1 - chance_agreement())
            assert abs(estimate - n / (n + 2 * more)) < 0.03


@pytest.mark.parametrize("seed", [3, 4])
def test_against_brute_force(documents, clashing, seed):
    rows = corpus(seed)
    found = near_duplicates(clashing(documents(rows)))
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()) == brute(rows)


def test_small_buckets_are_counted_out_too(documents, monkeypatch):
    monkeypatch.setattr(linking, "LARGE", 2)
    rows = corpus(5)
    found = near_duplicates(documents(rows))
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()) == brute(rows)


def test_nulls_and_repeated_ids(documents):
    text = " ".join(WORDS[:50])
    other = " ".join(WORDS[40:90])
    rows = [(7, text), (7, other), (2, other), (9, text + " more"), (None, text), (9, text + " more")]
    found = near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found if r.doc_id) == [(2, 2), (7, 2), (7, 2), (9, 2), (9, 2)]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, None)]
    assert near_duplicates(documents([])).count() == 0


def test_components(spark):
    pick = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = chain + [(pick.randrange(40), pick.randrange(40)) for _ in range(25)] + [(500, 200 + i) for i in range(50)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    want = reach({x for e in edges for x in e} - loops, edges)
    assert found == want


@pytest.fixture
def many_partitions(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [spark.conf.get(name) for name in names]
    for name, value in zip(names, ["100", "false"]):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def test_small_tables_take_few_files(spark, many_partitions):
    edges = [(i, i + 1) for i in range(0, 2000, 2)]
    found = components(spark.createDataFrame(edges, "a long, b long"), most=len(edges))
    assert found.count() == 2000
    assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
    buckets = [(k, i) for k in range(300) for i in (2 * k, 2 * k + 1)]
    members = linking.crowded(spark.createDataFrame(buckets, "bucket long, id long"))
    assert len(members.inputFiles()) <= spark.sparkContext.defaultParallelism
    sets = spark.createDataFrame([(i, list(range(i // 2, i // 2 + 20))) for i in range(600)], "id long, shingles array<long>")
    stars = linking.link_buckets(members, sets, 85, 100)
    assert {r.id: r.component for r in stars.collect()} == {i: i - i % 2 for i in range(600)}
    assert len(stars.inputFiles()) <= spark.sparkContext.defaultParallelism


def test_rows_worth_more_than_a_file_keep_their_partitions(spark):
    rows = spark.range(0, 1000, 1, 50)
    files = lambda size: len(saved(rows, "some", size).inputFiles())
    cores = spark.sparkContext.defaultParallelism
    assert [files(None), files(0), files(40 * FILE), files(80 * FILE)] == [50, min(cores, 50), max(cores, 40), 50]


def passages(seed=2):
    pick = random.Random(seed)
    text = lambda n: [pick.choice(WORDS) + pick.choice(WORDS) for _ in range(n)]
    shared = [text(n) for n in (50, 51, 90)]
    rows, holders = [], {}
    for k in range(60):
        words = text(pick.randrange(30, 300))
        if k < 18:
            passage = shared[k % 3]
            at = pick.randrange(len(words))
            words[at:at] = passage
            holders[k] = passage
        lines = " ".join(words[:100]) + "\n" + " ".join(words[100:])
        rows.append((k, "Same short line of nine words in all texts.\n" + lines))
    near = text(80)
    for k in range(60, 64):
        changed = list(near)
        changed[5 + k - 60] = "changed"
        rows.append((k, " ".join(text(20)) + "\n" + " ".join(changed) + "\n" + " ".join(text(30))))
        holders[k] = changed
    return rows, holders


def test_repeated_passages(documents, clashing):
    rows, holders = passages()
    found = repeated_passages(clashing(documents(rows))).collect()
    assert {r.doc_id for r in found} == set(holders)
    for r in found:
        words = dict(rows)[r.doc_id].split()[r.first : r.end]
        assert set(words) <= set(holders[r.doc_id]) and r.n_words == len(words)
    assert {r.doc_id for r in found if not r.removed} == {0, 1, 2, 60}
    assert {r.doc_id for r in found if r.removed} == set(holders) - {0, 1, 2, 60}


def test_passages_are_covered_from_end_to_end(documents):
    pick = random.Random(12)
    text = lambda n: [pick.choice(WORDS) + pick.choice(WORDS) for _ in range(n)]
    shared, rows, want = [text(n) for n in (50, 100, 200, 2000)], [], set()
    for k in range(12):
        before, passage = text(pick.randrange(5, 80)), shared[k % 4]
        rows.append((k, " ".join(before + passage[:30]) + "\n" + " ".join(passage[30:]) + "\n" + " ".join(text(39))))
        want.add((k, len(before), len(before) + len(passage), k >= 4, k % 4, 3))
    # 20 has the first 60 words of what 21 and 22 share whole.
    parts = text(60), text(25)
    rows += [(20, " ".join(parts[0] + text(50))), *((k, " ".join(text(9) + parts[0] + parts[1] + text(9))) for k in (21, 22))]
    found = repeated_passages(documents(rows)).collect()
    assert {tuple(r)[:3] + (r.removed, r.cluster_id, r.n_paragraphs) for r in found if r.doc_id < 20} == want
    more = {(r.doc_id, r.first, r.end, r.removed, r.cluster_id) for r in found if r.doc_id >= 20}
    assert {p for p in more if p[3]} == {(21, 9, 69, True, 20), (22, 9, 94, True, 20)}
    assert (20, 0, 60, False, 20) in more and max(p[2] for p in more if p[0] == 21) == 94


def test_passages_of_nothing(documents):
    rows = [(1, None), (2, ""), (None, "a b " * 60), (3, "a b"), (4, "x y z " * 40 + "\n" + "x y z " * 40), (4, "x y z " * 40)]
    assert repeated_passages(documents(rows)).count() == 0
    assert repeated_passages(documents([])).count() == 0


def test_bands_reach_their_recall():
    bands, rows = tune_bands(0.8, 0.999, 2)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 > 1 - (1 - 0.8**rows) ** (bands - 1)


def test_empty_shingles():
    assert len(shingle_set([])) == 0 and len(shingle_set([b"a", b"b"])) == 1 and BUCKETS == 130


@pytest.mark.parametrize("meetings", [0, 1, 3])
def test_agreement_of_tails_against_brute_force(spark, monkeypatch, meetings):
    monkeypatch.setattr(paragraphs, "MEETINGS", meetings)
    pick, tails = random.Random(meetings), {}
    for place in range(400):
        words = tuple(pick.choice((1, 1, 1, 2)) for _ in range(pick.choice((0, 1, 2, 3, 6, 6))))
        tails.setdefault((pick.randrange(6), pick.randrange(2), words), []).append((pick.randrange(30), 0, place))
    rows, number = [], {}
    for tail, ((low, right, words), places) in enumerate(tails.items()):
        number[low, right, words] = tail
        chain = [hash((right, words[: k + 1])) % 2**31 for k in range(len(words))]
        rows.append((*min(places), right, low, -low, tail, max(places)[0], len(places), chain))
    schema = "doc_id long, row_id long, first int, right int, low long, high long, tail long, last_id long, n long, chain array<int>"
    found = paragraphs._agreement(spark.createDataFrame(rows, schema), Scratch(spark)).collect()
    assert len(found) == len(tails)
    found = {r.tail: r for r in found}
    for (low, right, words), places in tails.items():
        reach, before, every = 0, 0, None
        for k in range(1, len(words) + 1):
            same = [p for (a, b, w), ps in tails.items() if (a, b, w[:k]) == (low, right, words[:k]) for p in ps if len(w) >= k]
            if len({p[0] for p in same}) > 1:
                reach, every = k, len(same)
                before = k if min(same) != min(places) else before
        r = found[number[low, right, words]]
        assert (r.any, r.behind) == (reach, before)
        # Asked only where a piece reaches further than what came before.
        assert reach == before or r.every == every


def test_lines_and_anchors_against_brute_force():
    pick = random.Random(5)
    text = "".join(pick.choice(["a", "b", "c", "\x0b", "\r", " ", " ", "\n", "\u00e4"]) for _ in range(4000)).encode()
    words, ranges = paragraphs.words_and_lines(text, 3)
    assert words == text.split()
    want, at = [], 0
    for line in text.split(b"\n"):
        if len(line.split()) >= 3:
            want.append((at, at + len(line.split())))
        at += len(line.split())
    assert ranges == want
    # Values that repeat within a line, at its ends, and across lines.
    lines = [np.array([pick.randrange(6) << 61 for _ in range(pick.randrange(1, 9))], np.uint64) for _ in range(200)]
    values, starts, low, high = paragraphs._sets([line.copy() for line in lines])
    ends = [*starts[1:], len(values)]
    for line, start, end, a, b in zip(lines, starts, ends, low, high, strict=True):
        each = sorted(set(map(int, line)))
        assert list(map(int, values[start:end])) == each
        assert int(a) == sum(each) % (1 << 64) - (1 << 63)
        folded = 0
        for x in paragraphs.mix(np.array(each, np.uint64)):
            folded ^= int(x)
        assert int(b) == folded - (1 << 63)
    for n in (0, 1, 5, 31, 32, 33, 400):
        found = np.array([pick.randrange(50) for _ in range(n)], np.uint64)
        least = {min(range(k, min(k + 32, n)), key=lambda i: found[i]) for k in range(max(n - 31, min(n, 1)))}
        n_words = n + 4
        assert list(paragraphs.anchors(found, n_words, 32)) == sorted(k for k in least if k + paragraphs.WINDOW <= n_words)


def test_hashes_leave_their_input_as_it_is():
    hashes = np.array([3, 5, 3, 5, 8, 1 << 63, 2, 7], np.uint64)
    before, mask = hashes.copy(), (1 << 64) - 1
    found = hashing.windows(hashes, 3)
    mixed = hashing.mix(hashes)
    assert (hashes == before).all() and len(mixed) == len(hashes) and not (mixed == before).any()
    base = 0x9E3779B97F4A7C15
    plain = [((int(a) * base + int(b)) * base + int(c) + 3) & mask for a, b, c in zip(before, before[1:], before[2:])]
    assert list(found) == list(hashing.mix(np.array(plain, np.uint64)))
    # Of equal shingles in reach of each other the first one counts.
    assert list(paragraphs.anchors(np.array([4, 4, 9, 4] + [9] * 40, np.uint64), 100, 3)) == [0, 1, 3, *range(4, 42)]
