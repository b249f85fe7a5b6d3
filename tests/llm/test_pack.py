import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vcat.llm import pack
from vcat.llm.textbytes import data

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = pack.encoder(PATH, 0)


def encode(texts, encoder=ENCODER):
    ids, bounds = encoder.encode(*data(pa.array(texts, pa.string())))
    return [ids[i:j - 1].tobytes() for i, j in zip(bounds, bounds[1:])]


def plain(texts):
    return [np.array(x.ids, "<u4").tobytes() for x in ENCODER.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_parts_give_the_ids_of_whole_texts(monkeypatch):
    texts = ["", " ", "It's  Fine, isn't\x1cit?", "á ́b", "ΑΣ ΑΣ. İx ﬁ", "x<|endoftext|>y <|startoftext|>", "naïve,,, ÉCOLE!! 3.14%", "don't...'s", " a b\x85c", "日本語 テスト。", "ée", "Å Å"]
    monkeypatch.setattr(pack, "KNOWN", 8)
    for _ in range(3):
        assert encode(texts) == plain(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_any_text(texts):
    assert encode(texts) == plain(texts)


def test_least_sum_of_squares_is_chosen():
    rng = random.Random(1)
    sizes, capacity = [rng.randint(1, 12) for _ in range(300)], 12
    bins = pack.sum_of_squares(np.array(sizes), capacity)
    gaps: dict[int, int] = {}

    def total(g):
        n = np.bincount([x for x in g.values() if x], minlength=capacity + 1)
        return int((n * n).sum())

    for s, b in zip(sizes, bins.tolist()):
        options = [total(gaps | {k: g - s}) for k, g in gaps.items() if g >= s] + [total(gaps | {len(gaps): capacity - s})]
        gaps[b] = gaps.get(b, capacity) - s
        assert gaps[b] >= 0 and total(gaps) == min(options)


def test_pieces_cover_documents_and_fill_sequences(docs, spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["aa", "b", "word", "é"]) for _ in range(rng.choice([0, 3, 40, 90, 400])))) for i in range(500)] + [(None, None), (7, "again"), (7, "again")]
    d = docs(rows)
    out = pack.pack(pack.tokenize(d, PATH, sequence=128), sequence=128, block=60)
    got = out.collect()
    want = []
    for (i, _), ids in zip(rows, plain([t or "" for _, t in rows])):
        raw = ids + b"\0\0\0\0"
        want += [(i, p, p * 128, len(raw[k:k + 512]) // 4, zlib.crc32(raw[k:k + 512])) for p, k in enumerate(range(0, len(raw), 512))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got) == sorted(map(key, want))
    seqs: dict[int, list] = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and sum(n for _, n in s) <= 128
    assert len(seqs) <= 1.05 * sum(r.length for r in got) / 128 + 1
    assert pack.pack(pack.tokenize(docs([]), PATH)).count() == 0


def test_sequences_hold_the_ids(docs):
    d = docs([(1, "one two three"), (2, "four"), (3, "x " * 50)])
    packed = pack.pack(pack.tokenize(d, PATH, sequence=32), sequence=32)
    for r in pack.sequences(d, packed, PATH, sequence=32).collect():
        assert len(r.ids) == sum(p.length for p in r.pieces) and [p.offset for p in r.pieces] == [sum(q.length for q in r.pieces[:i]) for i in range(len(r.pieces))]


def test_parts_are_forgotten_and_met_again(monkeypatch):
    monkeypatch.setattr(pack, "KNOWN", 50)
    own, rng = pack.Encoder(PATH), random.Random(3)
    for _ in range(40):
        texts = [" ".join(rng.choice(["often", "é", "x" * 70, "x" * 71, f"w{rng.randrange(300)}", "Don't,"]) for _ in range(30)) for _ in range(3)]
        assert encode(texts, own) == plain(texts) and len(own.hashes) <= 150


def test_a_very_long_text_and_a_very_long_word(docs):
    rows = [(1, "word " * 300_000), (2, "y" * 700_000)]
    got = pack.tokenize(docs(rows), PATH).collect()
    want = [len(x) // 4 + 1 for x in plain([t for _, t in rows])]
    assert [sum(r.length for r in got if r.doc_id == i) for i in (1, 2)] == want
