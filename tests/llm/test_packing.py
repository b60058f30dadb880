import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factloom.llm import packing


TOKENIZER = Tokenizer.from_file(packing.tokenizer_file())


def reference_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check_rows(rows, ids_by_doc, capacity):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(ids_by_doc)
    for doc, own in pieces.items():
        ids, at = ids_by_doc[doc], 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at & (at - 1) == 0 and at < capacity


@pytest.mark.parametrize("capacity", [64, 4096])
def test_round_trip(spark, documents, make, rng, capacity):
    rows = [(0, None), (1, ""), (2, "x"), (3, "Ünïcode  ßtraße ΑΣ don't <|endoftext|> <|ENDOFTEXT|> é"), (4, "  a b \x0b c")]
    rows += [(len(rows) + i, make(rng.randint(1, 900))) for i in range(120)]
    rows.append((len(rows), make(20_000)))
    got = packing.pack(documents(rows, extra=True).repartition(3), capacity=capacity).collect()
    check_rows(got, {i: reference_ids(t) for i, t in rows}, capacity)


def test_edge_tables(spark, documents):
    assert packing.pack(documents([])).count() == 0
    rows = packing.pack(documents([(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert sorted((r.doc_id or 0, r.start) for r in rows if r.start == 0) == [(0, 0), (1, 0), (1, 0)]


def brute_best(counts, capacity):
    items = [k for k, n in counts.items() for _ in range(n)]
    seed = max(items)
    items.remove(seed)
    sums = {0}
    for x in items:
        sums |= {s + x for s in sums if s + x <= capacity - seed}
    return seed + max(sums)


def test_window_is_filled_best():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.randint(10, 60)
        counts = {rng.randint(1, capacity): rng.randint(1, 4) for _ in range(rng.randint(1, 5))}
        used, slack = packing.fill_window(counts, capacity)
        total = sum(k * n for k, n in used.items())
        assert all(n <= counts[k] for k, n in used.items())
        assert total + slack == capacity
        assert total == brute_best(counts, capacity)


def ids_by_word(texts):
    ids, offsets = packing.coder(packing.tokenizer_file()).ids(pa.array(texts, pa.string()))
    return [ids[offsets[k] : offsets[k + 1]].tolist() for k in range(len(texts))]


@pytest.mark.parametrize("words", [["İ.", "İ,", "क़.", "שׁ."], ["ab.", "Ärger,", "œuvre.", "don't.", "x'S,", "ß.", "ŉ.", "ſ,", "ǆ.", "á.", "9.", "..", "<|endoftext|>.", "a<|endoftext|>b,"]])
def test_letters_that_fall_apart(words):
    texts = [*words, " ".join(words), *(f"{w} {w}" for w in words)]
    assert ids_by_word(texts) == [TOKENIZER.encode(x, add_special_tokens=False).ids for x in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=("Cs",)), max_size=12).map(lambda w: w + "."), max_size=6))
def test_any_text_gives_the_tokenizer_s_ids(words):
    texts = [" ".join(words), *words, *(w[:-1] for w in words), *(w[:-1] + "," for w in words)]
    want = [TOKENIZER.encode(x, add_special_tokens=False).ids for x in texts]
    assert ids_by_word(texts) == want


def test_dynamic_program_cuts_fewer_pieces_than_first_fit():
    rng = random.Random(3)
    lengths = [min(4000, int(rng.lognormvariate(5.5, 1))) + 1 for _ in range(3000)]
    cuts = []
    packer = packing.Packer(lambda piece, start, length, sequence, offset: cuts.append(start > 0))
    for k, n in enumerate(lengths):
        packer.add(k, n)
    packer.finish()
    room = first_fit = 0
    for n in lengths:  # fill windows in order of arrival and cut at each window's end
        if not room:
            room = packing.CAPACITY
        while n > room:
            first_fit, n, room = first_fit + 1, n - room, packing.CAPACITY
        room -= n
    assert sum(cuts) < 0.2 * first_fit
