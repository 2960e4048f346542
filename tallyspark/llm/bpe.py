"""Byte-level BPE encoding and decoding with tree concatenation for long texts.

Texts up to ``LEAF`` characters are encoded whole.  A longer text is cut into
leaves of ``LEAF`` characters which are encoded in parallel, wherever they
land; neighbours are then joined pairwise, level by level.  A join encodes a
window around the seam again and grows it until the new ids agree with the ids
of both sides at both ends of the window, which makes the joined ids those of
the whole text:

* Pieces (the units that merges never cross) are matched from left to right,
  and a match looks at most two characters past its end.  So the pieces of the
  left side other than its last ones are final, and once a piece of the window
  starts where a piece of the right side starts, the rest of the right side is
  final too.
* Inside one piece that runs across the seam, ids are right when every two
  neighbouring tokens encode to themselves; a window whose first and last
  tokens are those of the two sides has only such neighbours.

Special tokens in a text are ids of their own, as the tokenizers library makes
them; a text is split at them first, so no seam lies in one.

Encoding a piece uses tiktoken with the same vocabulary where every character
has the same class in both libraries' patterns (ASCII, Latin letters) and the
tokenizers library elsewhere.

Scale: no step holds more than one document; leaves and joins are keyed by the
digest of the text, so repeated long texts are encoded once.  Leaves are
written to the shared folder.

Defined cases: a null text encodes as an empty one; repeated rows each get
their result; an empty table gives an empty result; other columns pass.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.shared import own_name, written

VOCABULARY = "byte_bpe_50k"
LEAF = 65_536

#: Characters for which the two libraries' letter, number and space classes are the same.
SAME_CLASS = re.compile(r"[\t\n\r -~¡-¬®-ſ–—‘-”…]*")
CACHE_PIECES = 200_000


@functools.lru_cache(maxsize=2)
def vocabulary_of(name: str, folder: str | None) -> tuple[str, dict[bytes, int], dict[str, int], list[bytes]]:
    """File, ranks, special tokens, and the bytes of each id.  ``folder`` None: the installed package's."""
    import public_tokenizers

    folder = folder or os.path.dirname(public_tokenizers.path(""))
    file = os.path.join(folder, f"{name}.json")
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f)}
    with open(file) as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    bytes_of = [b""] * (max([*ranks.values(), *special.values()]) + 1)
    for b, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
        bytes_of[i] = b
    return file, ranks, special, bytes_of


def text_of(bytes_of: list[bytes], ids) -> str:
    return b"".join(map(bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Codec:
    """One tokenizer in one Python worker."""

    #: Windows of more characters re-encode a piece across the seam by tokens.
    LONG = 4096
    #: The pattern looks at most two characters past a piece, 8 bytes.
    LOOKAHEAD = 8

    def __init__(self, name: str, folder: str | None = None):
        import public_tokenizers
        import regex
        import tiktoken

        self.file, ranks, self.special, self.bytes_of = vocabulary_of(name, folder)
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        # The byte alphabet of byte-level BPE: printable Latin-1 stands for itself, the rest is moved above 255.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.letter = [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]
        self.cache: dict[str, list[int]] = {}

    @functools.cached_property
    def tok(self):
        """The tokenizers library's form, loaded when a text needs it."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(self.file)
        tok.no_padding()
        tok.no_truncation()
        return tok

    def parts(self, text: str) -> list[str]:
        """The text cut at special tokens; those are every second part."""
        return self.split(text) if any(s in text for s in self.special) else [text]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for i, part in enumerate(self.parts(text)):
            if i % 2:
                out.append(self.special[part])
            elif SAME_CLASS.fullmatch(part):
                out += self.fast.encode_ordinary(part)
            else:
                out += self.tok.encode(part, add_special_tokens=False).ids
        return out

    def encode_marked(self, text: str) -> tuple[list[int], list[bool]]:
        """Ids of a text without special tokens, and whether each starts a piece."""
        if not SAME_CLASS.fullmatch(text):
            e = self.tok.encode(text, add_special_tokens=False)
            w = e.word_ids
            return e.ids, [k == 0 or w[k] != w[k - 1] for k in range(len(w))]
        ids: list[int] = []
        starts: list[bool] = []
        for piece in self.pieces(text):
            got = self.cache.get(piece)
            if got is None:
                if len(self.cache) >= CACHE_PIECES:
                    self.cache.clear()
                got = self.fast.encode_ordinary(piece)
                if len(piece) < 64:
                    self.cache[piece] = got
            ids += got
            starts += [True] + [False] * (len(got) - 1)
        return ids, starts

    def merge_piece(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of one piece from those of its two parts, by a window of tokens that grows around the seam."""
        k = 2
        while True:
            a, b = left[-k:], right[:k]
            raw = b"".join(map(self.bytes_of.__getitem__, a + b))
            got = [t.id for t in self.tok.model.tokenize("".join(self.letter[x] for x in raw))]
            left_agrees = len(a) == len(left) or got[0] == a[0]
            right_agrees = len(b) == len(right) or got[-1] == b[-1]
            if left_agrees and right_agrees:
                return left[:len(left) - len(a)] + got + right[len(b):]
            k *= 2

    def join(self, left: Node, right: Node) -> Node:
        """Ids and piece starts of a text from those of its two halves."""
        (lid, lst), (rid, rst) = left, right
        if not len(lid) or not len(rid):
            return right if not len(lid) else left
        lpos, rpos = np.flatnonzero(lst), np.append(np.flatnonzero(rst), len(rid))
        k = 2
        while True:
            # From the k-th last piece of the left side to the k-th piece of the right side.
            a, b = int(lpos[-min(k, len(lpos))]), int(rpos[min(k, len(rpos) - 1)])
            whole_left, whole_right = k >= len(lpos), k >= len(rpos) - 1
            before = lid[a:].tolist()
            after = rid[:b].tolist()
            text = text_of(self.bytes_of, before + after)
            if len(text) > self.LONG and SAME_CLASS.fullmatch(text):  # a long piece: its ids by a window of tokens
                got = self.join_long(before, lst[a:].tolist(), after, rst[:b].tolist())
            else:
                got = self.encode_marked(text)
            gid, gst = np.asarray(got[0], "<u4"), np.asarray(got[1], bool)
            # Ends of the new pieces in bytes, against the starts of the right side's pieces.
            gends = np.cumsum([len(self.bytes_of[i]) for i in got[0]])
            size_left = sum(len(self.bytes_of[i]) for i in before)
            aends = size_left + np.cumsum([len(self.bytes_of[i]) for i in after])
            at = np.flatnonzero(gst)
            old = {size_left: 0} | {int(aends[p - 1]): int(p) for p in rpos[1:-1] if p < b}
            # The first new piece must be the left side's, and a later one must start where one of the right side does.
            first = int(at[1]) if len(at) > 1 else len(gid)
            left_agrees = whole_left or gid[:first].tolist() == before[:first]
            for p in at[1:]:
                start = int(gends[p - 1])
                if left_agrees and start in old and (whole_right or int(gends[-1]) - start >= self.LOOKAHEAD):
                    r = old[start]
                    return np.concatenate([lid[:a], gid[:p], rid[r:]]), np.concatenate([lst[:a], gst[:p], rst[r:]])
            if whole_left and whole_right or left_agrees and whole_right:
                return np.concatenate([lid[:a], gid]), np.concatenate([lst[:a], gst])
            k *= 2

    def join_long(self, before, bst, after, ast) -> tuple[list[int], list[bool]]:
        """Pieces of a long window: matched again by the pattern; a piece across the seam keeps most of its ids."""
        seam = len(b"".join(map(self.bytes_of.__getitem__, before)))
        text = text_of(self.bytes_of, before + after)
        ids: list[int] = []
        starts: list[bool] = []
        at = 0
        lcut = [i for i, s in enumerate(bst) if s][-1]
        tail_at = seam - sum(len(self.bytes_of[i]) for i in before[lcut:])
        rcut = next((i for i, s in enumerate(ast) if s and i), len(after))
        head_end = seam + sum(len(self.bytes_of[i]) for i in after[:rcut])
        for piece in self.pieces(text):
            n = len(piece.encode())
            if at == tail_at and at + n == head_end:
                got = self.merge_piece(before[lcut:], after[:rcut])
            else:
                got = self.fast.encode_ordinary(piece)
            ids += got
            starts += [True] + [False] * (len(got) - 1)
            at += n
        return ids, starts


Node = tuple[np.ndarray, np.ndarray]


@functools.lru_cache(maxsize=2)
def codec(name: str, folder: str | None) -> Codec:
    return Codec(name, folder)


def _pack(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _per_text(docs: DataFrame, text: str, names: list[str], types: list, work) -> DataFrame:
    """``docs`` with columns computed from each text by ``work(text) -> tuple``, in Arrow batches."""
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in zip(names, types)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            got = [work(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            new = [pa.array([g[k] for g in got], type=arrow.field(n).type) for k, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns, arrow)], *new], schema=arrow)

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, text: str = "text", out: str = "ids", vocabulary: str = VOCABULARY, folder: str | None = None,
           leaf: int = LEAF) -> DataFrame:
    """``docs`` with the column ``out``: the token ids of ``text`` as little-endian unsigned 32-bit integers."""
    def whole(t: str) -> tuple:
        return (_pack(codec(vocabulary, folder).encode(t)),)

    size = F.char_length(F.coalesce(F.col(text), F.lit("")))
    short = _per_text(docs.filter(size <= leaf), text, [out], [T.BinaryType()], whole)
    key = own_name(docs, "text_key")
    long = docs.filter(size > leaf).withColumn(key, F.sha2(F.col(text), 256))
    ids = encode_long(long.select(F.col(key).alias("key"), F.col(text).alias("text")), vocabulary, folder, leaf)
    ids = ids.select(F.col("key").alias(key), F.col("ids").alias(out))
    return short.unionByName(long.join(ids, key).drop(key))


def encode_long(texts: DataFrame, vocabulary: str = VOCABULARY, folder: str | None = None, leaf: int = LEAF) -> DataFrame:
    """key, ids of the distinct ``texts`` (key, text), by tree concatenation."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = 0
                for i, part in enumerate(codec(vocabulary, folder).parts(text)):
                    for at in range(0, len(part), leaf):
                        yield pa.RecordBatch.from_pydict({"key": [key], "no": [n], "special": [i % 2 == 1], "part": [part[at:at + leaf]]})
                        n += 1

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, no, special, part in zip(*[c.to_pylist() for c in batch.columns]):
                c = codec(vocabulary, folder)
                ids, starts = ([c.special[part]], [True]) if special else c.encode_marked(part)
                yield pa.RecordBatch.from_pydict({"key": [key], "no": [no], "lone": [special], "ids": [_pack(ids)],
                                                  "starts": [np.asarray(starts, bool).tobytes()]})

    cutted = (texts.groupBy("key").agg(F.first("text").alias("text"))
              .mapInArrow(cut, "key string, no long, special boolean, part string"))
    # Leaves are dealt evenly, whatever text they come from.
    nodes = cutted.repartition(F.xxhash64("key", "no")).mapInArrow(leaves, "key string, no long, lone boolean, ids binary, starts binary")
    nodes = written(nodes.select("key", "no", "ids", "starts", F.col("lone").alias("seal_left"), F.col("lone").alias("seal_right")), "bpe-leaves")
    most = nodes.agg(F.max("no")).first()[0] or 0
    while most > 0:
        nodes = (nodes.groupBy("key", F.floor(F.col("no") / 2).alias("pair")).applyInArrow(
            _pairs(vocabulary, folder), nodes.schema))
        most //= 2
    return nodes.select("key", "ids")


def _pairs(vocabulary: str, folder: str | None):
    def join(table: pa.Table) -> pa.Table:
        """The one or two neighbouring nodes of a group as one.

        A special token is a node whose sides are sealed: nothing is joined across them."""
        rows = sorted(table.to_pylist(), key=lambda r: r["no"])
        node = dict(rows[0])
        if len(rows) == 2:
            a, b = rows
            left, right = ((np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["starts"], bool)) for r in rows)
            if a["seal_right"] or b["seal_left"]:
                ids, starts = (np.concatenate(x) for x in zip(left, right))
            else:
                ids, starts = codec(vocabulary, folder).join(left, right)
            node |= {"ids": _pack(ids), "starts": np.asarray(starts, bool).tobytes(), "seal_left": a["seal_left"], "seal_right": b["seal_right"]}
        node["no"] = rows[0]["no"] // 2
        return pa.Table.from_pylist([node], schema=table.schema)
    return join


def decode(docs: DataFrame, ids: str = "ids", out: str = "decoded", vocabulary: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """``docs`` with the column ``out``: the text of the packed ``ids``, special tokens included; invalid bytes become U+FFFD."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        bytes_of = vocabulary_of(vocabulary, folder)[3]
        for batch in batches:
            got = [text_of(bytes_of, np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[col.cast(f.type) for col, f in zip(batch.columns, arrow)], pa.array(got, pa.string())], schema=arrow)

    return docs.mapInArrow(run, schema)
