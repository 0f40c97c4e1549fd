import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import clashing, documents  # noqa: F401
from nightledger.llm.packing import best_fit_packing, cut, plan, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "a  b\n\n c", "it's we'll 12345 ½ é ñ 漢字 🙂🏽", "x" * 700, "<|endoftext|> in text", "tab\tnew\r\n  end  ", "'s'S ’s"]


def best_fit(lengths, size):
    """Piece by piece: the tightest sequence that fits."""
    free = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in free if r >= length]
        if fitting:
            free.remove(min(fitting))
            free.append(min(fitting) - length)
        else:
            free.append(size - length)
    return len(free)


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
@settings(max_examples=100, deadline=None)
def test_plan_places_all_without_gaps_as_well_as_best_fit(counts):
    placed, ranks = defaultdict(list), defaultdict(list)
    for length, low, high, each, first, offset in plan(counts, 30):
        for rank in range(low, high):
            ranks[length].append(rank)
            placed[first + (rank - low) // each].append((offset + (rank - low) % each * length, length))
    assert {length: sorted(r) for length, r in ranks.items()} == {length: list(range(n)) for length, n in counts.items()}
    for pieces in placed.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 30
    assert len(placed) == best_fit(Counter(counts).elements(), 30)


def test_cut():
    assert cut(5, 2) == [(0, 1), (1, 2), (3, 2)]
    assert cut(4, 2) == [(0, 2), (2, 2)]
    assert cut(1, 2) == [(0, 1)]


def test_ids_are_those_of_tokenizers():
    plain = Tokenizer.from_file(PATH)
    for text in TEXTS:
        assert tokenizer(PATH).ids(text) == plain.encode(text, add_special_tokens=False).ids


def test_documents(documents, clashing):
    plain = Tokenizer.from_file(PATH)
    rows = [*enumerate([*TEXTS, "many words of some length " * 3000]), (50, None), (None, "no id"), (3, TEXTS[3])]
    found = best_fit_packing(clashing(documents(rows)), PATH).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((doc_id, k, a, n, zlib.crc32(ids[a : a + n].tobytes())) for k, (a, n) in enumerate(cut(len(ids))))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == best_fit([r.length for r in found], 2048)


def test_empty_table(documents):
    assert best_fit_packing(documents([]), PATH).count() == 0
