"""Cross-tokenizer alignment against brute force by cumulated byte lengths."""
import hashlib
from collections import Counter

import public_tokenizers
import pytest

from renewcast.llm.alignment import Pieces, Transducer, align, op13_alignment

ODD_TEXTS = [None, "", " ", "a", "  two  spaces\n\tand lines ", "<|endoftext|> <s> </s> <unk> plain", "▁literal mark", "é ü ß 漢字 😀  ", "zero\x00byte", "x" * 5000, " " * 3000, "don't re-do it's 12345"]


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in plain)}
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found, links = [], Counter()
    for doc, text in rows:
        if not text:
            found.append((doc, None))
            continue
        a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
        bytes_a = [bytes(back[c] for c in left.id_to_token(k)) for k in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if right.is_byte(k) else p.replace("▁", " ").encode() for k in b for p in [right.id_to_piece(k)]]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append((doc, None))
            continue

        def ends(parts):
            out, n = {}, 0
            for k, x in enumerate(parts):
                n += len(x)
                out[n] = k
            return out

        ea, eb = ends(bytes_a), ends(bytes_b)
        both = sorted(ea.keys() & eb.keys())
        links.update((a[ea[e]], b[eb[e]]) for e in both)
        found.append((doc, (a, b, [ea[e] + 1 for e in both], [eb[e] + 1 for e in both])))
    top = {}
    for (_, y), n in links.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for doc, x in found:
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, ea, eb = x
        mine = [(a[i - 1], b[j - 1]) for i, j in zip(ea, eb)]
        text = ";".join(",".join(map(str, a[p:q])) + "|" + ",".join(map(str, b[r:s])) for p, q, r, s in zip([0, *ea], ea, [0, *eb], eb))
        out.append((doc, len(a), len(b), len(ea), len(mine), sum(links[m] == top[m[1]] for m in mine), sum(links[m] for m in mine), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_on_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op13_alignment(spark, sf).collect()), key=str)
    assert got == brute(rows) and sum(r[5] for r in got) > 0


@pytest.mark.parametrize("table", [1 << 22, 10])
def test_odd_rows(spark, odd, table):
    rows = [(100 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(100, "a"), (None, "a"), (3, "aaaa " * 3000)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr("*", "1 AS n_a", "'x' AS pairs")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, align(docs, table=table).select(*COLUMNS).collect()), key=str) == want
    assert align(docs.limit(0), table=table).count() == 0


def test_groups_are_kept(spark):
    r = align(spark.createDataFrame([(1, "hello world")], "doc_id long, text string"), groups=True).first()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 and r.groups.count(";") == r.n_groups - 1


def test_transducer():
    """Either side leads; what contradicts or stays dangling has no groups; forgetting changes nothing."""
    a, b = [b"ab", b"c", b"abc", b"d"], [b"a", b"bc", b"abcd", b"x"]
    for memory in (1, 1 << 10):
        t = Transducer(a, b, memory)
        for _ in range(2):
            assert t.groups([0, 1, 2], [0, 1, 0, 1]) == ([2, 3], [2, 4])
            assert t.groups([2, 3], [2]) == ([2], [1]) and t.groups([], []) == ([], [])
            assert t.groups([0, 1], [3]) is None and t.groups([0], [0]) is None and t.groups([2], [2]) is None and t.groups([], [0]) is None and t.groups([2], [0, 1, 0]) is None


def test_piece_bytes():
    p = Pieces()
    assert p.bytes[p.model.piece_to_id("<0x0A>")] == b"\n" and p.bytes[p.model.piece_to_id("▁the")] == b" the"
