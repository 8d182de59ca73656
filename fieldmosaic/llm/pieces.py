"""SentencePiece encoding and decoding as a max-plus parallel scan.

Segmentation is a best path through the lattice of pieces. A long text is cut into chunks at fixed
places. The state at a cut is the piece that ends at it or reaches across it; a chunk is the
matrix of the best path weights from each entry state to each exit state, with minus infinity where
there is none. Matrices are combined by max-plus products, which are associative: blocks of
chunks in one round, blocks of blocks in the next. The way back hands every block its two states,
then every chunk, and each chunk is traced back on its own.

In a merge (BPE) model a segmentation is the right one exactly if every two neighbouring pieces
stay as they are when their joint text is merged on its own; such pairs have weight 0, others
minus infinity, so the only path left is the encoding of the library. In a unigram
model weights are the scores of the file. Where the vocabulary has no piece with a blank after another
character, no path crosses the start of a word, so a matrix is the outer product of the part
before the chunk's first word start and the part after its last, and whole words between them
are looked up in a table that the library fills. Texts below two chunks need no cut and are looked up whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2

from fieldmosaic.llm.common import documents, identified, stored
from fieldmosaic.llm.registry import query
from fieldmosaic.llm.word_ids import WordIds, code_points

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 13  # characters; texts of two chunks or more are split
FAN = 64  # chunks or blocks in a block
BLANK = "▁"
NEG = float("-inf")
SLICE_CHARS = 1 << 18  # characters whose words are looked up at a time
SLOTS = 1 << 19  # of the word table of a worker: 262,144 words, most of which never return
MATRIX = "array<array<double>>"


class Pieces:
    """Vocabulary, weights and neighbour rule of a model file."""

    def __init__(self, data: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        proto = sentencepiece_model_pb2.ModelProto.FromString(data)
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
            raise ValueError("only models that keep the text as it is and put one blank before it are supported")
        self.merges = proto.trainer_spec.model_type == 2
        usable = [(p.piece, i, p.score) for i, p in enumerate(proto.pieces) if p.type in (1, 4)]
        self.ids = {piece: i for piece, i, _ in usable}
        self.scores = {piece: score for piece, _, score in usable}
        self.longest = max(map(len, self.ids))
        self.least = min(self.scores.values()) - 10.0
        self.by_words = not any(BLANK in piece.lstrip(BLANK) for piece in self.ids)
        self.words = WordIds(self._encode, SLOTS)
        special = {p.piece for p in proto.pieces if p.type not in (1, 4, 6)}
        self.raw = [None if p.piece in special else bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(BLANK, " ").encode() for p in proto.pieces]
        self.leads = [p.piece.startswith(BLANK) for p in proto.pieces]
        self.stays = lru_cache(1 << 15)(self._stays)

    def merged(self, text: str) -> list[str]:
        """Merging by score, the leftmost of equals first."""
        parts = list(text)
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda k: (self.scores.get(parts[k] + parts[k + 1], NEG), -k))
            if parts[best] + parts[best + 1] not in self.scores:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _stays(self, left: str, right: str) -> bool:
        return self.merged(left + right) == [left, right]

    def fits(self, left: str, right: str) -> bool:
        return not left or not self.merges or (self.by_words and right[0] == BLANK and left[-1] != BLANK) or self.stays(left, right)

    def weight(self, piece: str) -> float:
        return 0.0 if self.merges else self.scores.get(piece, self.least)

    def starting(self, text: str, at: int, upto: int):
        """Ends of the pieces that start here; an unknown character is a piece of its own."""
        for end in range(at + 1, min(at + self.longest, upto) + 1):
            if end == at + 1 or text[at:end] in self.ids:
                yield end

    def states(self, text: str, cut: int) -> list[tuple[str, int]]:
        """(piece, characters beyond the cut) of all pieces that start before and end at or after it."""
        found = []
        for at in range(max(0, cut - self.longest), cut):
            found.extend((text[at:end], end - cut) for end in self.starting(text, at, len(text)) if end >= cut)
        return found

    def search(self, text: str, at: int, before: str, cut: int) -> dict[tuple[int, str], tuple[float, tuple | None]]:
        """Best weight and predecessor of every node (end, piece) reached by pieces that start before the cut."""
        nodes: dict[tuple[int, str], tuple[float, tuple | None]] = {(at, before): (0.0, None)}
        ready: dict[int, list[tuple[int, str]]] = {at: [(at, before)]}
        for place in range(at, cut):
            for node in ready.pop(place, ()):
                weight = nodes[node][0]
                for end in self.starting(text, place, len(text)):
                    piece = text[place:end]
                    if not self.fits(node[1], piece):
                        continue
                    total = weight + self.weight(piece)
                    known = nodes.get((end, piece))
                    if known is None:
                        ready.setdefault(end, []).append((end, piece))
                    if known is None or total > known[0]:
                        nodes[end, piece] = (total, node)
        return nodes

    def trace(self, nodes: dict, node: tuple[int, str]) -> list[str]:
        path = []
        while nodes[node][1] is not None:
            path.append(node[1])
            node = nodes[node][1]
        return path[::-1]

    def numbers(self, pieces: list[str]) -> list[int]:
        """Ids; characters outside the vocabulary become their UTF-8 bytes, or the unknown id."""
        out = []
        for piece in pieces:
            if piece in self.ids:
                out.append(self.ids[piece])
            else:
                codes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in piece.encode("utf-8", "replace")]
                out.extend(codes if self.library.unk_id() not in codes else [self.library.unk_id()])
        return out

    def _encode(self, words: list[str]) -> list:
        done = self.library.encode([w[1:].replace(BLANK, " ") for w in words], num_threads=1)
        return [ids if len(w) > 1 else self.numbers([w]) for w, ids in zip(words, done)]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that each start with a blank and may be cut at word starts, all looked up together."""
        if not self.by_words:
            return [np.array(self.library.encode(t[1:].replace(BLANK, " ")), np.int32) for t in texts]
        joined = "".join(texts)
        codes, bounds = code_points(joined), np.cumsum([0, *map(len, texts)])
        blank = codes == ord(BLANK)
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[bounds[bounds < len(codes)]] = True
        starts = np.flatnonzero(start)
        ids, upto = self.words.ids(joined, codes, starts, np.append(starts[1:], len(codes))[: len(starts)])
        ends = upto[np.searchsorted(starts, bounds)].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def text(self, ids: list[int]) -> str:
        """What the library decodes; it is only asked where ids are no plain text."""
        try:
            found = b"".join([self.raw[k] for k in ids]).decode()
        except (TypeError, IndexError, UnicodeDecodeError):
            return self.library.decode(ids)
        return found[1:] if ids and self.leads[ids[0]] else found


@lru_cache(2)
def loaded(data: bytes) -> Pieces:
    return Pieces(data)


def read_model(model: str) -> bytes:
    """The model file; its bytes are sent along with the tasks, so workers need no file."""
    with open(model, "rb") as file:
        return file.read()


def pieces(model: str) -> Pieces:
    return loaded(read_model(model))


def written(text: str) -> str:
    """The text as the lattice sees it."""
    return BLANK + text.replace(" ", BLANK) if text else ""


class Chunk:
    """Characters lo to hi of a text, within a margin of a longest piece on both sides."""

    def __init__(self, p: Pieces, context: str, lead: int, size: int, first: bool, last: bool):
        self.p, self.text, self.lo, self.hi, self.first, self.last = p, context, lead, lead + size, first, last
        starts = [m.start() + 1 for m in re.finditer(f"[^{BLANK}]{BLANK}", context[self.lo : self.hi])] if p.by_words else []
        starts = [self.lo + s for s in starts if self.lo + s < self.hi]
        self.from_, self.upto = (starts[0], starts[-1]) if starts else (None, None)
        self.entries = [("", 0)] if first else p.states(context, self.lo)
        self.exits = [("", 0)] if last else p.states(context, self.hi)

    @property
    def simple(self) -> bool:
        return self.from_ is not None

    def _weight_to(self, nodes: dict, cut: int, state: tuple[str, int] | None):
        """Best node that realises a state at the cut; any piece that ends there for None."""
        if state is not None:
            node = (cut + state[1], state[0])
            return (nodes[node][0], node) if node in nodes else (NEG, None)
        ends = [(w, node) for node, (w, _) in nodes.items() if node[0] == cut]
        return max(ends, default=(NEG, None))

    def _exit(self, j: int):
        return None if self.last else self.exits[j]

    def matrix(self) -> list[list[float]]:
        if not self.simple:
            rows = []
            for before, over in self.entries:
                nodes = self.p.search(self.text, self.lo + over, before, self.hi)
                rows.append([self._weight_to(nodes, self.hi, self._exit(j))[0] for j in range(len(self.exits))])
            return rows
        heads = [self._weight_to(self.p.search(self.text, self.lo + over, before, self.from_), self.from_, None)[0] if self.lo + over < self.from_ else (0.0 if self.lo + over == self.from_ else NEG) for before, over in self.entries]
        nodes = self.p.search(self.text, self.upto, "", self.hi)
        tails = [self._weight_to(nodes, self.hi, self._exit(j))[0] for j in range(len(self.exits))]
        return [[h + t for t in tails] for h in heads]

    def encode(self, entry: int, leave: int) -> tuple[list[int], str, list[int]]:
        """Ids up to the first word start, the words that need no search, and ids from the last word start on."""
        before, over = self.entries[entry]
        at, p = self.lo + over, self.p
        if not self.simple:
            nodes = p.search(self.text, at, before, self.hi)
            return p.numbers(p.trace(nodes, self._weight_to(nodes, self.hi, self._exit(leave))[1])), "", []
        head = []
        if at < self.from_:
            nodes = p.search(self.text, at, before, self.from_)
            head = p.numbers(p.trace(nodes, self._weight_to(nodes, self.from_, None)[1]))
        nodes = p.search(self.text, self.upto, "", self.hi)
        return head, self.text[self.from_ : self.upto], p.numbers(p.trace(nodes, self._weight_to(nodes, self.hi, self._exit(leave))[1]))


def cuts_of(text: str, chunk: int, longest: int):
    """(number, context, lead, size, first, last) of the chunks of a written text."""
    count = max(1, len(text) // chunk)
    for k in range(count):
        lo, hi = k * chunk, len(text) if k == count - 1 else (k + 1) * chunk
        start = max(0, lo - longest)
        yield k, text[start : hi + longest], lo - start, hi - lo, k == 0, k == count - 1


def product(left: list, right: list) -> list[list[float]]:
    """Max-plus product."""
    a, b = np.array(left, float), np.array(right, float)
    return (a[:, :, None] + b[None, :, :]).max(axis=1).tolist()


CUTS = "no int, context string, lead int, size int, first boolean, last boolean"


def _chunks(data: bytes, chunk: int):
    def run(batches):
        p = loaded(data)
        for batch in batches:
            for key, doc, text in zip(batch["_key"], batch["_id"], batch["_text"]):
                yield pd.DataFrame([(key, doc, *c) for c in cuts_of(written(text), chunk, p.longest)], columns=["_key", "_id", "no", "context", "lead", "size", "first", "last"])

    return run


def _members(batch: pd.DataFrame, p: Pieces):
    for c, lead, size, first, last in zip(*(batch[x] for x in ("context", "lead", "size", "first", "last"))):
        yield Chunk(p, c, lead, size, first, last)


def _transfers(data: bytes):
    """The matrix of every chunk."""

    def run(batches):
        p = loaded(data)
        for batch in batches:
            yield pd.DataFrame({"_key": batch["_key"], "no": batch["no"], "matrix": [c.matrix() for c in _members(batch, p)]})

    return run


def _combine(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("no")
    matrices = [[list(r) for r in m] for m in group["matrix"]]
    total = matrices[0]
    for matrix in matrices[1:]:
        total = product(total, matrix)
    return pd.DataFrame({"_key": [group["_key"].iloc[0]], "no": [int(group["no"].iloc[0]) // FAN], "matrix": [total]})


def _hand_down(group: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit state of every member of a block, from those of the block."""
    group = group.sort_values("no")
    matrices = [np.array([list(r) for r in m], float) for m in group["matrix"]]
    ahead = [None] * len(matrices) + [np.full(matrices[-1].shape[1], NEG)]
    ahead[-1][int(group["out"].iloc[0])] = 0
    for k in range(len(matrices) - 1, -1, -1):
        ahead[k] = (matrices[k] + ahead[k + 1][None, :]).max(axis=1)
    state, rows = int(group["in"].iloc[0]), []
    for k, (key, no) in enumerate(zip(group["_key"], group["no"])):
        following = int((matrices[k][state] + ahead[k + 1]).argmax())
        rows.append((key, no, state, following))
        state = following
    return pd.DataFrame(rows, columns=["_key", "no", "in", "out"])


def boundary_states(chunks: DataFrame, data: bytes) -> DataFrame:
    """(_key, no, in, out): the states of every chunk on the best path, by up-sweep and down-sweep."""
    fields = f"_key string, no int, matrix {MATRIX}"
    levels = [stored(chunks.mapInPandas(_transfers(data), fields).dropDuplicates(["_key", "no"]), "matrices")]  # rows with equal id and text
    block = F.floor(F.col("no") / FAN).cast("int").alias("block")
    tasks = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small rows, long work: not to be merged into few tasks
    while not levels[-1].where("no > 0").isEmpty():
        levels.append(stored(levels[-1].withColumn("block", block).repartition(tasks, "_key", "block").groupBy("_key", "block").applyInPandas(_combine, fields), "matrices"))
    states = levels[-1].select("_key", "no", F.lit(0).alias("in"), F.lit(0).alias("out"))
    for level in reversed(levels[:-1]):
        given = states.withColumnRenamed("no", "block")
        states = stored(level.withColumn("block", block).join(given, ["_key", "block"]).repartition(tasks, "_key", "block").groupBy("_key", "block").applyInPandas(_hand_down, "_key string, no int, in int, out int"), "states")
    return states


def _short(data: bytes):
    def run(batches):
        p = loaded(data)

        def done(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            ids = p.many(texts)
            bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(bounds, np.concatenate(ids).astype(np.int32))], ["_key", "_id", "ids"])

        for batch in batches:
            at, texts, chars = 0, [], 0
            for k, text in enumerate(batch.column(2)):
                texts.append(written(text.as_py()))
                chars += len(texts[-1])
                if chars >= SLICE_CHARS or k == batch.num_rows - 1:
                    yield done(batch.slice(at, len(texts)), texts)
                    at, texts, chars = k + 1, [], 0

    return run


def _backtrace(data: bytes):
    def run(batches):
        p = loaded(data)
        for batch in batches:
            rows = max(1, SLICE_CHARS // max(1, int(batch["size"].max())))
            for at in range(0, len(batch), rows):
                part = batch.iloc[at : at + rows]
                heads, words, tails = zip(*(c.encode(i, o) for c, i, o in zip(_members(part, p), part["in"], part["out"])))
                ids = [np.concatenate([np.array(h, np.int32), w, np.array(t, np.int32)]) for h, w, t in zip(heads, p.many(list(words)), tails)]
                yield pd.DataFrame({"_key": part["_key"], "no": part["no"], "ids": ids})

    return run


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """One row per row of `docs`: id, ids, as the library encodes the whole text.

    A text of less than two chunks is one chunk with one state on either side. Null and empty
    texts have no ids. Rows with equal id and text get equal ids.
    """
    if chunk < 64:
        raise ValueError("a chunk must be longer than two pieces")
    data = read_model(model)
    rows = identified(docs, doc_id, text)
    kind = rows.schema["_id"].dataType.simpleString()
    size = F.length("_text")
    short = rows.where(size < 2 * chunk - 1).select("_key", "_id", "_text").mapInArrow(_short(data), f"_key string, _id {kind}, ids array<int>").select(F.col("_id").alias("id"), "ids")
    long = rows.where(size >= 2 * chunk - 1).mapInPandas(_chunks(data, chunk), f"_key string, _id {kind}, {CUTS}")
    chunks = stored(long, "chunks")
    states = boundary_states(chunks, data)
    traced = chunks.drop("_id").join(states.hint("merge"), ["_key", "no"]).mapInPandas(_backtrace(data), "_key string, no int, ids array<int>")
    # one state per chunk is never broadcast; the join deals the chunks of a text out
    whole = traced.groupBy("_key").agg(F.flatten(F.transform(F.array_sort(F.collect_set(F.struct("no", "ids"))), lambda c: c["ids"])).alias("ids"))
    return short.union(chunks.where("no = 0").select("_key", F.col("_id").alias("id")).join(whole, "_key").select("id", "ids"))


def decode(encoded: DataFrame, ids: str = "ids", name: str = "text", model: str = MODEL) -> DataFrame:
    """Add the text of a column of ids. It equals the encoded one, but that U+2581 in it has become a blank; null ids give null."""
    data = read_model(model)

    @F.arrow_udf("string")
    def restored(column: pa.Array) -> pa.Array:
        p = loaded(data)
        values, bounds = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        texts = (p.text(values[a:b].tolist()) if known else None for a, b, known in zip(bounds, bounds[1:], column.is_valid().to_pylist()))
        return pa.array(texts, pa.string(), size=len(column))  # a text at a time

    return encoded.withColumn(name, restored(ids))


@query("op9_sentencepiece")
def op9_sentencepiece(spark, sf_dir):
    done = decode(encode(documents(spark, sf_dir)))
    digest = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256)
    return done.select(F.col("id").alias("doc_id"), F.size("ids").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
