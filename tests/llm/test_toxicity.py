import random
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd

from llm_fixtures import clashing, documents, labels  # noqa: F401
from nightledger.llm.common import shared_folder
from nightledger.llm.toxicity import PIECE, BlockMaxIndex, _scored, isotonic, terms, toxicity_scores

BAD = ["vile", "rotten", "grobian", "canalla"]
WORDS = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "mp")]


def table(n=800, seed=1):
    pick = random.Random(seed)
    rows, marks = [], []
    for k in range(n):
        words = [pick.choice(WORDS) for _ in range(pick.randrange(20, 120))]
        toxic = k % 7 == 0
        if toxic:
            for _ in range(4):
                words[pick.randrange(len(words))] = pick.choice(BAD)
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(toxic)))
    return rows, marks


def test_nearest_is_exact():
    pick = random.Random(3)
    idf = {w: 1 + pick.random() * 5 for w in WORDS[:60]}
    examples = [(k, k % 3 == 0, Counter(pick.choices(WORDS[:80], k=pick.randrange(0, 25)))) for k in range(700)]
    index = BlockMaxIndex(idf, [(k, int(t), c) for k, t, c in examples], 0.3, (1.0, 1.0))
    dense = np.zeros((len(index.ids), len(idf)))
    by_id = {k: c for k, _, c in examples}
    for at, k in enumerate(index.ids):
        numbers, values = index.vector(by_id[k])
        dense[at, numbers] = values
    for _ in range(60):
        numbers, values = index.vector(Counter(pick.choices(WORDS[:80], k=pick.randrange(0, 30))))
        query = np.zeros(len(idf))
        query[numbers] = values
        cosine = dense @ query
        want = np.sort(cosine[cosine > 1e-12])[::-1][:15]
        found = index.nearest(numbers, values)
        assert np.allclose([c for c, _ in found], want)
        assert all(np.isclose(cosine[at], c) for c, at in found)


def test_scores_of_held_out_rows(documents, labels, clashing):
    rows, marks = table()
    found = toxicity_scores(clashing(documents(rows)), labels(marks)).collect()
    assert len(found) == len(rows)
    held = [r for r in found if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    toxic = [r.predicted for r in held if r.doc_id % 7 == 0]
    fine = [r.predicted for r in held if r.doc_id % 7]
    assert np.mean(toxic) > 0.95 and np.mean(fine) < 0.03
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert any(r.evidence and r.evidence[0].toxic == 1 for r in found if r.doc_id % 7 == 0)


def test_held_out_labels_teach_nothing(documents, labels):
    rows, marks = table(300)
    first = {r.doc_id: (r.score, r.held_out) for r in toxicity_scores(documents(rows), labels(marks)).collect()}
    turned = [(k, q, 1 - t if first[k][1] else t) for k, q, t in marks]
    second = {r.doc_id: r.score for r in toxicity_scores(documents(rows), labels(turned)).collect()}
    assert second == {k: s for k, (s, _) in first.items()}


def test_odd_tables(documents, labels):
    rows, marks = table(300)
    odd = [(1000, None), (1001, ""), (None, "vile rotten vile"), (1002, "vile rotten " * 20_000), (1003, "! ? ."), (1, "vile")]
    found = toxicity_scores(documents(rows + odd), labels([*marks, (1, None, None), (None, 1, 1), (0, 1, 1), (0, 1, 0)])).collect()
    by_text = {r.doc_id: r.score for r in found[-6:]} | {r.doc_id: r.score for r in found if r.doc_id in (1000, 1001, 1002, 1003)}
    assert len(found) == 306 and by_text[1000] == by_text[1001] == by_text[1003] < 0.3 < by_text[1002]
    assert [r.score for r in toxicity_scores(documents(odd), labels([])).collect()] == [0.0] * 6
    assert toxicity_scores(documents([]), labels([])).count() == 0


def test_terms_and_isotonic():
    assert terms("Loser! loser, Worthless") == {"loser": 2, "worthless": 1, "worth*": 1}
    levels = isotonic(np.array([0, 5, 1, 9.0]), np.array([10, 10, 10, 10.0]))
    assert list(levels) == sorted(levels) and len(levels) == 4


def test_evidence_is_passed_on_in_pieces_and_not_stored(spark, documents, labels):
    index = BlockMaxIndex({w: 1.0 for w in BAD}, [(k, 1, Counter([BAD[k % 4]])) for k in range(40)], 0.5, (1.0, 1.0))
    batch = pd.DataFrame({"doc_id": range(2 * PIECE + 3), "text": ["vile text"] * (2 * PIECE + 3)})
    pieces = list(_scored(iter([batch]), index))
    assert [len(p) for p in pieces] == [PIECE, PIECE, 3] and [k for p in pieces for k in p["doc_id"]] == list(batch["doc_id"])
    rows, marks = table(300)
    assert toxicity_scores(documents(rows), labels(marks)).count() == 300
    folder = Path(shared_folder(spark).removeprefix("file://").removeprefix("file:"), "llm")
    assert list(folder.glob("examples-*")) and not list(folder.glob("votes-*"))
