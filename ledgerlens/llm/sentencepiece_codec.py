"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed on the driver and rebuilt as a tokenizer: its normaliser (escaped
blanks and the dummy prefix), the metaspace marker, pieces with their scores (a unigram model, or
the merges that a BPE model's scores order) and byte fallback. No piece of such a model joins a
marker to what stands before it, so a text is cut before each run of markers and each different
segment of a run of documents is encoded once, in multithreaded batches. Every encoded segment is
compared with the sentencepiece library's own result and decoded back; a text with a difference is
marked (a unigram model reads the name of a byte piece, such as <0x41>, standing in a text as that piece).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_MEMO = 200_000  # different segments a task remembers
_LONG = 64  # longer ones are not remembered
_RUN = 20  # new segments encoded as one text


class Model:
    """What encoding and decoding need of a parsed model."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        self.data = data
        self.pieces = [(p.piece, p.score) for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        self.unk = kinds.index(2)
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.unigram = proto.trainer_spec.model_type == 1
        spec = proto.normalizer_spec
        self.prefix, self.squeeze, self.charsmap = spec.add_dummy_prefix, spec.remove_extra_whitespaces, bytes(spec.precompiled_charsmap)
        self.normal, self.control = [k == 1 for k in kinds], [k == 3 for k in kinds]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if k == 6 else b"" if k in (2, 3) else p.encode() for (p, _), k in zip(self.pieces, kinds)]
        # a text without double blanks is then its words with a marker before each
        self.plain = self.prefix and not self.squeeze and not self.charsmap
        # cutting at markers is exact if no piece has a marker after anything else
        self.cuttable = not any(re.search(f"[^{MARK}]{MARK}", p) for p, k in zip((p for p, _ in self.pieces), kinds) if k in (1, 4))
        self.plain = self.plain and self.cuttable

    def tokenizer(self):
        """The model as a tokenizers.Tokenizer of normalised text."""
        from tokenizers import Tokenizer, decoders, models, normalizers

        ids = {p: i for i, (p, _) in enumerate(self.pieces)}
        if self.unigram:
            # control pieces are no text: they get names that no text is taken to hold
            model = models.Unigram([(f"\U0010FFFE{p}" if k else p, s) for (p, s), k in zip(self.pieces, self.control)], self.unk, self.byte_fallback)
        else:
            merges = []
            for i, (piece, score) in enumerate(self.pieces):
                if self.normal[i] and len(piece) > 1:
                    merges += [(-score, i, ids[piece[:k]], piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids]
            merges.sort()
            # a task remembers what it encoded itself; the model's own cache would only hold long runs of segments
            model = models.BPE(ids, [(a, b) for *_, a, b in merges], cache_capacity=0, unk_token=self.pieces[self.unk][0], fuse_unk=True, byte_fallback=self.byte_fallback)
        out = Tokenizer(model)
        if self.charsmap:
            out.normalizer = normalizers.Precompiled(self.charsmap)
        out.decoder = self._decoder(decoders)
        return out

    def _decoder(self, decoders):
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        return decoders.Sequence(steps + [decoders.Strip(" ", 1, 0)] if self.prefix else steps)

    def normal_form(self, text: str) -> str:
        """Blanks escaped and the dummy prefix added (an identity normaliser changes nothing else)."""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)


_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _gather(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` that begin and size name, one after the other."""
    if not len(begin):
        return pool[:0]
    return pool[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class Codec:
    """A model in a task: encodes segments once, keeps their ids and whether they were verified."""

    def __init__(self, model: Model, threads: int):
        import os

        import sentencepiece

        T.frugal()
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.model, self.tok = model, model.tokenizer()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model.data)
        self.threads = threads
        self.piece_size = np.fromiter(map(len, model.bytes_of), np.int64, len(model.bytes_of))
        self.piece_bytes = np.frombuffer(b"".join(model.bytes_of), np.uint8)
        self.piece_begin = np.cumsum(self.piece_size) - self.piece_size
        self.known: dict[str, int] = {}
        self.clear()

    def clear(self):
        self.known.clear()
        self.pool, self.size, self.good = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)

    def _own(self, segments: list[str]) -> list[list[int]]:
        """The sentencepiece library's ids of segments."""
        lead = self.sp.encode("a") if self.model.prefix else []
        plain = [(s[1:] if self.model.prefix else s).replace(MARK, " ") for s in segments]
        blank = [i for i, p in enumerate(plain) if not p.strip(" ")]
        out = self.sp.encode(plain, num_threads=1)
        for i in blank:  # a run of markers at a text's end: alone it would not get a prefix
            out[i] = self.sp.encode("a" + segments[i].replace(MARK, " "))[len(lead):] if lead else out[i]
        return out

    def _alone(self, segments: list[str]):
        """Ids of each segment and whether the library's are the same."""
        lists = [e.ids for e in self.tok.encode_batch_fast(segments, add_special_tokens=False)]
        return lists, [a == b for a, b in zip(lists, self._own(segments))]

    def learn(self, keys: list[str], segments: list[str]) -> None:
        """Encode new segments in multithreaded batches, check each against sentencepiece and decode it back.

        Segments are encoded some at a time as one text, whose ids are cut where their pieces' bytes
        reach the segments' ends; where they do not, or the library differs, each is encoded alone.
        """
        lone = [i for i, s in enumerate(segments) if not s.strip(MARK) or not s.startswith(MARK) or not self.model.cuttable]
        rest = sorted(set(range(len(segments))) - set(lone)) if lone else range(len(segments))
        runs = [rest[i: i + _RUN] for i in range(0, len(rest), _RUN)]
        texts = ["".join([segments[i] for i in r]) for r in runs]
        encoded = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        own = self.sp.encode([(t[1:] if self.model.prefix else t).replace(MARK, " ") for t in texts], num_threads=1)
        ids = np.fromiter((i for x in encoded for i in x), np.int32)
        reach = np.cumsum(self.piece_size[ids])
        length = np.fromiter((len(segments[i].encode()) for i in rest), np.int64, len(rest))
        ends = np.cumsum(length)
        cut = np.searchsorted(reach, ends, side="left") + 1
        whole = _gather(self.piece_bytes, self.piece_begin[ids], self.piece_size[ids]).tobytes() == "".join(texts).encode()
        fits = whole and len(ids) and np.array_equal(reach[np.minimum(cut, len(reach)) - 1], ends)
        if fits and encoded == own:
            order, sizes, pool, good = list(rest), np.diff(cut, prepend=0), ids, np.ones(len(rest), bool)
        else:
            lone, order, sizes, pool, good = list(range(len(segments))), [], np.zeros(0, np.int64), ids[:0], np.zeros(0, bool)
        if lone:
            lists, same = self._alone([segments[i] for i in lone])
            for i, x, ok in zip(lone, lists, same):
                text = b"".join(self.model.bytes_of[p] for p in x)
                good = np.append(good, ok and text == segments[i].encode())
                sizes, pool = np.append(sizes, len(x)), np.append(pool, np.array(x, np.int32))
            order += lone
        first = len(self.size)
        self.known.update((keys[i], first + n) for n, i in enumerate(order))
        self.pool, self.size, self.good = np.concatenate((self.pool, pool)), np.concatenate((self.size, sizes)), np.concatenate((self.good, good))

    def _cut(self, text: str) -> list[str]:
        """A text's segments; one marker before a word is left out of its key."""
        if self.model.plain and MARK not in text:
            words = text.split(" ")
            if "" not in words:
                return words
        normal = self.model.normal_form(text)
        return (_SEGMENT.findall(normal) if self.model.cuttable else [normal]) if normal else []

    def encode(self, texts: list[str]):
        """Ids of all texts one after the other, how many each has, and whether all of its segments agreed."""
        if len(self.known) > _MEMO:
            self.clear()
        cut = [self._cut(t) for t in texts]
        per_text = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = [s for c in cut for s in c]
        new = list(set(flat) - self.known.keys())
        if new:
            self.learn(new, [s if s.startswith(MARK) or not self.model.plain else MARK + s for s in new])
        at = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        m = self.size[at]
        ids = _gather(self.pool, (np.cumsum(self.size) - self.size)[at], m) if len(at) else self.pool[:0]
        ends = np.cumsum(per_text)
        tokens, bad = np.concatenate(([0], np.cumsum(m))), np.concatenate(([0], np.cumsum(~self.good[at])))
        for s in new:
            if len(s) > _LONG:
                del self.known[s]
        return ids, tokens[ends] - tokens[ends - per_text], bad[ends] == bad[ends - per_text]


def decode(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of runs of ids."""
    size = np.fromiter(map(len, model.bytes_of), np.int64, len(model.bytes_of))
    pool, begin = np.frombuffer(b"".join(model.bytes_of), np.uint8), np.cumsum(size) - size
    out, lo = [], 0
    for n in counts:
        mine = ids[lo: lo + n]
        lo += n
        text = _gather(pool, begin[mine], size[mine]).tobytes().decode("utf-8", "replace").replace(MARK, " ")
        out.append(text[1:] if model.prefix and text.startswith(" ") else text)
    return out


def _encode_fn(shared, threads):
    def run(batches):
        codec = None
        for batch in batches:
            codec = codec or Codec(T.received(shared), threads)
            column = batch.column(batch.num_columns - 1)
            _, off = T.text_buffers(column)
            for i, j in T.slices(off, 1 << 19):
                texts = column.slice(i, j - i).to_pylist()
                ids, counts, agreed = codec.encode([t or "" for t in texts])
                back = decode(codec.model, ids, counts)
                nulls = pa.array([t is None for t in texts])
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids), mask=nulls)
                rest = [batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)]
                trip = pa.array([b == (t or "") for b, t in zip(back, texts)])
                yield pa.RecordBatch.from_arrays([*rest, tokens, pa.array(counts), trip, pa.array(agreed)], [*batch.schema.names[:-1], "token_ids", "n_tokens", "round_trip", "parity"])
    return run


def _model(spark, model_path: str):
    with open(model_path, "rb") as f:  # on the driver; a model is a few MB at most and goes by broadcast
        return T.send(spark, Model(f.read()))


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH, threads: int = 2) -> DataFrame:
    """(id, token_ids, n_tokens, round_trip, parity) for each row of ``docs``.

    round_trip: decoding the ids gives the text (false for a text that itself holds the marker);
    parity: the sentencepiece library gives the same ids. A null text has null ids and no tokens;
    an empty one has none. Very long texts are encoded whole, segment by segment. Repeated rows are
    encoded each. Other columns are not read.
    """
    base = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = base.schema[id_col].dataType.simpleString()
    return base.mapInArrow(_encode_fn(_model(docs.sparkSession, model_path), threads), f"`{id_col}` {kind}, token_ids array<int>, n_tokens long, round_trip boolean, parity boolean")


def encoded_table(docs: DataFrame, **kw) -> DataFrame:
    """``encoded``, run now with small Arrow batches and written to a table in the shared folder."""
    with T.lean_batches(docs.sparkSession, 4 << 20):
        return T.stored(encoded(docs, **kw))


def _decode_fn(shared):
    def run(batches):
        model = T.received(shared)
        for batch in batches:
            column = batch.column(1)
            if isinstance(column, pa.ChunkedArray):
                column = column.combine_chunks()
            lists = column.fill_null([]) if column.null_count else column
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            texts = decode(model, lists.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())], pa.string())], batch.schema.names)
    return run


def decoded(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids", text_col: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """(id, text) of each row's ids; null ids give a null text."""
    base = tokens.select(F.col(id_col).alias(id_col), F.col(ids_col).alias(text_col))
    kind = base.schema[id_col].dataType.simpleString()
    return base.mapInArrow(_decode_fn(_model(tokens.sparkSession, model_path)), f"`{id_col}` {kind}, `{text_col}` string")
