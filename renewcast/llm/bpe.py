"""BPE encoding and decoding of whole texts, exactly as the tokenizers library does it.

Tree concatenation: a text of more than ``LEAF`` characters is cut in halves, wherever the middle falls, down to
leaves; leaves are encoded apart, and a window around each join is encoded again and grown until, on either
side, it holds two neighbouring tokens that the half has too, with the same ids and places.  A token sequence
is the BPE encoding of its text if each neighbouring pair is one in some correct encoding, so what is put
together at such places is exact.  Texts over ``PART`` bytes are cut into parts that are dealt over the tasks,
so that their leaves are encoded in parallel, and joined likewise.

Leaves are encoded by their distinct words: words between ASCII white space are independent for a tokenizer
that drops white space, so each is encoded once by the library while it is remembered (words are compared by
their bytes).  What is remembered is bounded by ``CACHE`` bytes, and texts are taken in steps of bounded size.

Nulls count as empty; empty texts give no ids and an empty decoded text.  Ties and repeated rows are encoded
row by row; other columns of the input are kept, whatever their names, unless they bear an output's name,
which is replaced.  An empty table gives no rows.
"""
from __future__ import annotations

import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renewcast.llm.textkernel import SPACE, ranges, texts, word_spans

TOKENIZER = "word_bpe_49k.json"
LEAF, PART, CACHE, TOGETHER = 4096, 1 << 16, 20 << 20, 200
_WORD = ~SPACE


class Encoded:
    """A text's ids with the places (characters) of the tokens."""

    def __init__(self, text: str, ids, start, end):
        self.text, self.ids, self.start, self.end = text, np.asarray(ids, np.uint32), np.asarray(start, np.int64), np.asarray(end, np.int64)

    def cut(self, a: int, b: int, shift: int = 0) -> tuple:
        return self.ids[a:b], self.start[a:b] + shift, self.end[a:b] + shift


def _pairs(e: Encoded, first: int, last: int, shift: int) -> dict:
    """Of the tokens first to last: place of each pair of neighbours that meet at a character's edge, to the
    second one's index."""
    ids, start, end = e.ids[first:last].tolist(), (e.start[first:last] + shift).tolist(), (e.end[first:last] + shift).tolist()
    return {(ids[k], ids[k + 1], start[k], end[k], start[k + 1], end[k + 1]): first + k + 1 for k in range(len(ids) - 1) if end[k] <= start[k + 1]}


def join(encode, left: Encoded, right: Encoded) -> Encoded:
    """The encoding of left.text + right.text."""
    n, m = len(left.text), 8
    while True:
        i, j = max(0, len(left.ids) - m), min(len(right.ids), m)
        a = int(left.start[i]) if i else 0
        b = int(right.end[j - 1]) if j < len(right.ids) else len(right.text)
        w = encode(left.text[a:] + right.text[:b])
        mine = _pairs(w, 0, len(w.ids), a)
        from_left = from_right = None
        if i == 0:
            from_left = (0, 0)
        else:
            theirs = _pairs(left, i, len(left.ids), 0)
            from_left = next(((theirs[p], k) for p, k in mine.items() if p in theirs), None)
        if j == len(right.ids):
            from_right = (len(w.ids), len(right.ids))
        else:
            theirs = _pairs(right, 0, j, n)
            from_right = next(((k, theirs[p]) for p, k in reversed(mine.items()) if p in theirs), None)
        if from_left and from_right and from_left[1] <= from_right[0]:
            parts = [left.cut(0, from_left[0]), w.cut(from_left[1], from_right[0], a), right.cut(from_right[1], len(right.ids), n)]
            return Encoded(left.text + right.text, *(np.concatenate(x) for x in zip(*parts)))
        m *= 2


def join_all(encode, parts: list[Encoded]) -> Encoded:
    """Neighbours joined from below."""
    while len(parts) > 1:
        parts = [join(encode, *parts[k:k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


class Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.held, self.n = np.zeros(1024, dtype), 0

    def add(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.held):
            self.held = np.concatenate([self.held[:self.n], np.zeros(self.n + 2 * len(x), self.held.dtype)])
        self.held[self.n:self.n + len(x)] = x
        self.n += len(x)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.held[at]


class Coder:
    """Encodes and decodes texts.  plain: special tokens in a text are ordinary text."""

    def __init__(self, name: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain
        # With no decoder in the file, the library puts the tokens' own texts together with blanks.
        self.token = pa.array([self.tokenizer.id_to_token(k) or "" for k in range(self.tokenizer.get_vocab_size())], pa.large_string()) if self.tokenizer.decoder is None else None
        self.clear()

    def clear(self):
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.first, self.count = Grown(np.int64), Grown(np.int64)
        self.ids, self.start, self.end = Grown(np.uint32), Grown(np.int32), Grown(np.int32)

    def encode(self, text: str) -> Encoded:
        """By the library, with no tree."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        off = np.array(e.offsets, np.int64).reshape(-1, 2)
        return Encoded(text, e.ids, off[:, 0], off[:, 1])

    def _together(self, words: list[bytes]) -> tuple:
        """(ids, start, end, number of tokens by word) of words encoded by one call."""
        plain = [w.decode() for w in words]
        e = self.encode(" ".join(plain))
        begin = np.append(0, np.cumsum([len(w) + 1 for w in plain]))
        of = np.searchsorted(begin, e.start, "right") - 1
        return e.ids, e.start - begin[of], e.end - begin[of], np.bincount(of, minlength=len(words))

    def learn(self, words: list[bytes]) -> None:
        """Have all the words known; forget others if these would be too much beside them."""
        new = list({w: None for w in words if w not in self.known})
        if not new:
            return
        if self.held > CACHE:
            self.clear()
            new = list(dict.fromkeys(words))
        long = [w for w in new if len(w) > LEAF]
        if long:
            new = [w for w in new if len(w) <= LEAF]
        found = [self._together(new[i:i + TOGETHER]) for i in range(0, len(new), TOGETHER)]
        for w in long:
            e = self.tree(w.decode(), self.encode)
            found.append((e.ids, e.start, e.end, np.array([len(e.ids)])))
        new += long
        count = np.concatenate([x[3] for x in found])
        self.first.add(self.ids.n + np.cumsum(count) - count)
        self.count.add(count)
        for x in found:
            for k, of in enumerate((self.ids, self.start, self.end)):
                of.add(x[k])
        n = len(self.known)
        self.known.update(zip(new, range(n, n + len(new))))
        self.held += sum(map(len, new)) + 100 * len(new) + 12 * int(count.sum())

    def _gather(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of each token among those remembered, and how many each word has."""
        known = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return ranges(self.first[known], self.count[known]), self.count[known]

    def leaf(self, text: str) -> Encoded:
        """By words, with places."""
        raw = text.encode()
        words = raw.split()
        self.learn(words)
        at, count = self._gather(words)
        data = np.frombuffer(raw, np.uint8)
        begin = word_spans(data, np.array([0, len(data)]), _WORD)[0]
        if len(raw) != len(text):
            begin = np.append(0, np.cumsum((data & 0xC0) != 0x80))[begin]
        shift = np.repeat(begin, count)
        return Encoded(text, self.ids[at], self.start[at] + shift, self.end[at] + shift)

    def tree(self, text: str, leaf=None) -> Encoded:
        """Halves down to LEAF characters, joined from below."""
        leaf = leaf or self.leaf
        if len(text) <= LEAF:
            return leaf(text)
        half = len(text) // 2
        return join(self.encode, self.tree(text[:half], leaf), self.tree(text[half:], leaf))

    def step(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a step, and where each text's begin (one more at the end)."""
        split = [raw.split() if len(raw) <= LEAF else () for raw in raws]
        words = [w for ws in split for w in ws]
        # Trees may make the coder forget, so the others' words are gathered before.
        self.learn(words)
        at, count = self._gather(words)
        short, edge = self.ids[at], np.append(0, np.cumsum(count))[np.append(0, np.cumsum([len(ws) for ws in split]))]
        if all(len(raw) <= LEAF for raw in raws):
            return short, edge
        parts = [short[edge[i]:edge[i + 1]] if len(raw) <= LEAF else self.tree(raw.decode()).ids for i, raw in enumerate(raws)]
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))

    def decode(self, ids: np.ndarray, edge: np.ndarray) -> pa.Array:
        """The texts of ids, by the library's rule; edge: where each text's begin."""
        if self.token is None:
            return pa.array([self.tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.string())
        lists = pa.LargeListArray.from_arrays(pa.array(edge, pa.int64()), self.token.take(pa.array(ids)))
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def _raw(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def _binary(flat: np.ndarray, edge: np.ndarray) -> pa.Array:
    data = flat.astype("<u4")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edge) - 1, [None, pa.py_buffer((edge * 4).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def encode(docs: DataFrame, text: str = "text", out: str = "ids", tokenizer: str = TOKENIZER, plain: bool = False, part: int = PART, decoded: str | None = None) -> DataFrame:
    """docs with ``out``: the text's ids as little-endian unsigned 32-bit integers (binary); ``decoded`` names a
    column for what they decode to, which is made in the same pass."""
    added = [T.StructField(out, T.BinaryType())] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    docs = docs.drop(*(f.name for f in added))
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, *added])
    at = names.index(text)

    def outputs(coder, ids, edge):
        return [_binary(ids, edge), *([coder.decode(ids, edge)] if decoded else [])]

    def short(batches):
        coder = Coder(tokenizer, plain)
        for batch in batches:
            for first, data, off in texts(batch.column(at)):
                raw, o = data.tobytes(), off.tolist()
                rows = batch.slice(first, len(o) - 1)
                yield pa.record_batch([*rows.columns, *outputs(coder, *coder.step([raw[a:b] for a, b in zip(o[:-1], o[1:])]))], names=schema.names)

    size = F.coalesce(F.octet_length(text), F.lit(0))
    rest = F.struct(*(F.col(f"`{c}`") for c in names if c != text)) if len(names) > 1 else F.struct(F.lit(0).alias("none"))
    packed = docs.where(size > part).select(F.monotonically_increasing_id().alias("row"), rest.alias("rest"), F.col(text).alias("text"))
    whole = _encode_long(packed, tokenizer, plain, part, bool(decoded), outputs)
    whole = whole.select(*(F.col("text").alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in names), F.col("ids").alias(out), *([F.col("decoded").alias(decoded)] if decoded else []))
    return docs.where(size <= part).mapInArrow(short, schema).unionByName(whole)


_FRAGMENT = pa.struct([("text", pa.string()), ("ids", pa.binary()), ("start", pa.binary()), ("end", pa.binary())])


def _encode_long(packed: DataFrame, tokenizer: str, plain: bool, part: int, decoded: bool, outputs) -> DataFrame:
    """(rest, text, ids, decoded) of long texts.  The other columns travel with a text's first part."""
    piece = T.StructType([T.StructField("row", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("rest", packed.schema["rest"].dataType), T.StructField("text", T.StringType())])
    fragment = T.StructType([T.StructField(c, T.StringType() if c == "text" else T.BinaryType()) for c in ("text", "ids", "start", "end")])
    coded = T.StructType([*piece.fields, T.StructField("split", T.BooleanType()), T.StructField("head", fragment), T.StructField("middle", T.BinaryType()), T.StructField("tail", fragment)])
    result = T.StructType([piece["rest"], piece["text"], T.StructField("ids", T.BinaryType())] + ([T.StructField("decoded", T.StringType())] if decoded else []))

    def cut(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].as_py().encode()
                a = k = 0
                while a < len(raw):
                    b = min(len(raw), a + part)
                    while b < len(raw) and raw[b] & 0xC0 == 0x80:
                        b += 1
                    own = batch.column(1).slice(i, 1)
                    yield pa.record_batch([batch.column(0).slice(i, 1), pa.array([k], pa.int32()), own if not k else pa.nulls(1, own.type), pa.array([raw[a:b].decode()])], names=piece.names)
                    a, k = b, k + 1

    def fragment_of(e: Encoded) -> dict:
        return {"text": e.text, "ids": _raw(e.ids), "start": e.start.tobytes(), "end": e.end.tobytes()}

    def some(batches):
        coder = Coder(tokenizer, plain)
        for batch in batches:
            for i, t in enumerate(batch.column(3).to_pylist()):
                raw = t.encode()
                place = np.flatnonzero(SPACE[np.frombuffer(raw, np.uint8)])
                # What stands before the first and behind the last white space may go on in other parts.
                a, b = (int(place[0]), int(place[-1]) + 1) if len(place) else (len(raw), len(raw))
                head, middle, tail = (coder.tree(raw[x:y].decode()) for x, y in ((0, a), (a, b), (b, len(raw))))
                yield pa.record_batch([*batch.slice(i, 1).columns, pa.array([bool(len(place))]), pa.array([fragment_of(head)], _FRAGMENT), pa.array([_raw(middle.ids)], pa.binary()), pa.array([fragment_of(tail)], _FRAGMENT)], names=coded.names)

    def whole(table: pa.Table) -> pa.Table:
        coder = Coder(tokenizer, plain)
        back = lambda x: Encoded(x["text"], np.frombuffer(x["ids"], "<u4"), np.frombuffer(x["start"], np.int64), np.frombuffer(x["end"], np.int64))
        table = table.sort_by("part")
        ids, held = [], []
        for x in table.select(["split", "head", "middle", "tail"]).to_pylist():
            held.append(back(x["head"]))
            if x["split"]:
                ids += [join_all(coder.encode, held).ids, np.frombuffer(x["middle"], "<u4")]
                held = [back(x["tail"])]
        ids.append(join_all(coder.encode, held).ids)
        ids = np.concatenate(ids)
        return pa.table([table["rest"].slice(0, 1), pa.array(["".join(table["text"].to_pylist())]), *outputs(coder, ids, np.array([0, len(ids)]))], names=result.names)

    return packed.mapInArrow(cut, piece).repartition("row", "part").mapInArrow(some, coded).groupBy("row").applyInArrow(whole, result)


def decode(rows: DataFrame, ids: str = "ids", out: str = "decoded", tokenizer: str = TOKENIZER) -> DataFrame:
    """rows with ``out``: the text of the ids, special tokens kept.  Null ids count as none."""
    rows = rows.drop(out) if out in rows.columns else rows
    at = rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        coder = Coder(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                raws = [x or b"" for x in some.column(at).to_pylist()]
                edge = np.append(0, np.cumsum([len(x) // 4 for x in raws]))
                yield pa.record_batch([*some.columns, coder.decode(np.frombuffer(b"".join(raws), "<u4"), edge)], names=schema.names)

    return rows.mapInArrow(run, schema)


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode(docs, decoded="decoded")
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
