"""What every packing must satisfy."""

import zlib


def check_packing(rows, ids_of, window=2048):
    """Every id in one piece, sequences gapless, lengths the window or a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids_of)
    for doc, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids_of[doc])
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids_of[doc][r["start"] : at].tobytes())
        assert at == len(ids_of[doc])
    padded = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded
