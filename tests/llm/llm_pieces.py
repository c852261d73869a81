"""Checks the contract of packed pieces."""

import zlib

import numpy as np

from corpusloom.llm import pretokens


def check_pieces(pieces, texts, window=1024):
    """Every id in exactly one piece, sequences without gaps; the padding."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(pretokens.vocabulary_path())
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = np.array([*lib.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding
