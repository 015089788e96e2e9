import zlib

import numpy as np

from strandlake.llm import packing


def test_cut():
    for n in range(1, 300):
        pieces = packing.cut(n, 64)
        assert [s for s, _ in pieces] == np.cumsum([0, *(k for _, k in pieces)])[:-1].tolist()
        assert sum(k for _, k in pieces) == n and all(k & (k - 1) == 0 and k <= 64 for _, k in pieces)
        short = [k for _, k in pieces if k < 64]
        assert short == sorted(set(short), reverse=True)


def test_round_trip(documents):
    from tokenizers import Tokenizer

    frame, rows = documents
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    want = sorted(((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t in rows), key=repr)
    packed = packing.pack(frame, max_len=256, with_ids=True)
    assert packed.columns[:5] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    pieces = packed.collect()
    assert len({p["sequence_id"] for p in pieces}) == len(pieces) and {p["offset"] for p in pieces} == {0}
    for p in pieces:
        assert len(p["ids"]) == p["length"] and p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
    # pieces of rows with equal ids hold equal texts here
    found = {}
    for p in pieces:
        found.setdefault((p["doc_id"], p["doc_tokens"]), {}).setdefault(p["start"], set()).add(tuple(p["ids"]))
    for d, ids in want:
        parts = found[d, len(ids)]
        assert tuple(x for s in sorted(parts) for x in next(iter(parts[s]))) == ids


def test_odd_texts():
    from tokenizers import Tokenizer

    e, plain = packing.encoder(packing.vocabulary_path()), Tokenizer.from_file(packing.vocabulary_path())
    odd = ["İstanbul ǅ ΑΣ Σ a.b c.. d!? naïve é Å ﬁ don't I'LL 12ab \x85z a b <|endoftext|> 😀", "ŉ ſ", "\t\n", "É, ö. Ÿ; ẞ", "x" * 5000, "＂ — … ­ zero​width", "\x1c\x1d a\x0bb\x0cc",
           "a<|endoftext|>b <|startoftext|>", "<|endoftext|>\u0301 e", "x <|ENDOFTEXT|>y <|endoftext|", "<|endoftext|><|endoftext|>\n", "y" * 40_000 + " z"]
    for t in odd:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t
    assert max(map(len, [*e, *e.words])) <= packing.REMEMBERED_LENGTH


def test_no_rows_and_buckets(no_documents, documents, tmp_path):
    assert packing.pack(no_documents).count() == 0
    frame, _ = documents
    packing.write_buckets(packing.pack(frame, max_len=128), str(tmp_path / "b"))
    assert {p.name for p in (tmp_path / "b").iterdir() if p.is_dir()} <= {f"bucket={1 << i}" for i in range(8)}
