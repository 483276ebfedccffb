"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut into words only where no piece of the table can cross: characters that stand side by side in some piece form
classes, and a word is a run of one class with the spaces before it (no piece has a space after another character; a table
that has makes whole texts of one class). The best path of a text is then that of its words. For the distinct words
of all chunks of documents, substrings of bounded length are exploded
and equi-joined to the piece table; the matching edges of a word, which stay together, are folded
into the best path (Viterbi), many words at once and each once for all chunks. A cogroup by chunk then puts the words' pieces together, document by document.
Texts travel to their chunk as compressed rows of many texts, words go back to it as their pieces alone, which spell them. Words that
are frequent (at most ``FREQUENT``) are encoded once for all chunks, by the same steps, and words of over ``WORD`` characters, which
are few, by the same lattice in a loop where the texts are put together: packed edges have no room for them.

A path's cost is the sum of its pieces' costs (distances of their scores from the best score). Characters that no piece
covers cost more than any piece and become byte pieces, so decoding gives back every text exactly. Literal
U+2581 is such a character, because pieces use it for the space. In a model trained as BPE the scores are
merge ranks: the path is the best under them, which need not be what replaying the merges gives.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small, written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
WORD = 32  # characters of a word with its spaces that goes through the joined lattice
CHUNK_BYTES = 6 << 20
PACK_BYTES = 400_000  # of texts that travel to a chunk as one row
FREQUENT = 1 << 18
# Frequent words are looked for in one document of so many, by a hash of its text; the choice has no bearing on results.
SAMPLED = 16
# A packed edge, from the high bits: end (6), cost (31), start (6), id (20). A way to a place is the same without the
# end, with the cost of the whole way.
ID_BITS, COST_BITS, AT_BITS = 20, 31, 6
LOW = AT_BITS + ID_BITS
EDGES = 60_000  # that are folded at once, and the rest of a batch
NO_PIECE = (1 << ID_BITS) - 1


def load_pieces(model: str = MODEL) -> tuple[list[tuple[str, int, int]], list[int], list[bytes]]:
    """((surface, id, cost) of the normal pieces; ids of the 256 byte pieces; bytes of every id).

    Fractional scores count in thousandths. A model has less than 2^20 pieces, so the table can be broadcast.
    """
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    if n >= NO_PIECE:
        raise ValueError(f"a piece table of {n} rows; fewer than {NO_PIECE} can be sent to every executor")
    normal = [k for k in range(n) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k) or sp.is_byte(k))]
    scores = {k: sp.get_score(k) for k in normal}
    scale = 1 if all(s == int(s) for s in scores.values()) else 1000
    best = max(scores.values())
    table = [(sp.id_to_piece(k).replace(SPACE, " "), k, round((best - scores[k]) * scale) + scale) for k in normal]
    if (dearest := max(c for _, _, c in table) + 1) >= 1 << COST_BITS or dearest * (WORD + 2) >= 1 << 63 - LOW:
        raise ValueError("the scores lie too far apart")
    byte_ids, raw = [-1] * 256, [b""] * n
    for k in range(n):
        if sp.is_byte(k):
            value = int(sp.id_to_piece(k)[3:5], 16)
            byte_ids[value], raw[k] = k, bytes([value])
    if min(byte_ids) < 0:
        raise ValueError("the model lacks byte pieces, so it can't give back every text")
    for surface, k, _ in table:
        raw[k] = surface.encode()
    return table, byte_ids, raw


def cuts(table: list[tuple[str, int, int]]) -> str:
    """The expression of a text's words: between two of them no piece of the table can lie."""
    parent: dict[str, str] = {}

    def top(c: str) -> str:
        while (up := parent.setdefault(c, c)) != c:
            parent[c] = c = parent[up]
        return c

    for surface, _, _ in table:
        own = surface.lstrip(" ")
        if " " in own:
            return r"[\s\S]+"
        for x, y in zip(own, own[1:]):
            parent[top(x)] = top(y)
    classes: dict[str, list[str]] = {}
    for c in parent:
        classes.setdefault(top(c), []).append(c)
    runs = [" *[" + "".join(map(re.escape, sorted(own))) + "]+" for own in sorted(classes.values(), key=lambda own: (-len(own), own)) if len(own) > 1]
    # A character that meets itself only ("..", if no class has it) is a class of its own.
    runs += [f" *{re.escape(c)}+" for c in sorted({x for surface, _, _ in table for x, y in zip(surface, surface[1:]) if x == y != " "}) if len(classes[top(c)]) == 1]
    return "|".join([*runs, r" *[^ ]", " +"])


def best_path(word: str, table: dict[str, tuple[int, int]], longest: int, unknown: int, byte_ids: list[int]) -> list[int]:
    """The ids of a word's cheapest path, in a loop; of equal costs that with the longest last piece."""
    cost, way = [0], [(0, 0)]
    for end in range(1, len(word) + 1):
        best = None
        for start in range(max(0, end - longest), end):
            if found := table.get(word[start:end]):
                new = (cost[start] + found[1], start, found[0])
            elif start == end - 1:
                new = (cost[start] + unknown, start, -1)
            else:
                continue
            if best is None or new[:2] < best[:2]:
                best = new
        cost.append(best[0])
        way.append(best[1:])
    path, at = [], len(word)
    while at:
        start, id_ = way[at]
        path.append([byte_ids[b] for b in word[start:at].encode("utf-8", "surrogatepass")] if id_ < 0 else [id_])
        at = start
    return [k for part in reversed(path) for k in part]


def best_paths(words: DataFrame, keys: list[str], table: list[tuple[str, int, int]], byte_ids: list[int], carried: list[str] | None = None) -> DataFrame:
    """``words`` (keys and word, distinct, of 1 to ``WORD`` characters) as keys, word, the ``carried`` columns and ids (array<int>): the
    cheapest path.

    Of equal costs the path with the longest last piece wins. A word's rows stay together, in the partition of its keys:
    the explode, the broadcast join and the fold add no shuffle and no sort.
    """
    pieces = words.sparkSession.createDataFrame(table, "piece string, id int, cost int")
    longest = max(len(p) for p, _, _ in table)
    unknown = max(c for _, _, c in table) + 1
    own = [*keys, "word", *(carried or [])]
    head = (F.col("start") == 0) & (F.col("end") == 1)
    found = (words.select(*own, F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
             .select(*own, "start", F.explode(F.sequence(
                 F.col("start") + 1, F.least(F.col("start") + longest, F.length("word")))).alias("end"))
             # The first row of a word carries its columns, the others stay small.
             .select(F.col("word").substr(F.col("start") + 1, F.col("end") - F.col("start")).alias("piece"),
                     *[F.when(head, F.col(c)).alias(c) for c in own], "start", "end")
             .join(F.broadcast(pieces), "piece", "left"))
    # A single character is an edge in any case, so every word has a path.
    found = found.where(F.col("id").isNotNull() | (F.col("end") - F.col("start") == 1))
    edge = (F.shiftleft(F.col("end").cast("long"), COST_BITS + LOW)
            + F.shiftleft(F.coalesce("cost", F.lit(unknown)).cast("long"), LOW)
            + F.shiftleft(F.col("start").cast("long"), ID_BITS) + F.coalesce("id", F.lit(NO_PIECE)).cast("long"))
    schema = T.StructType([*[words.schema[c] for c in own], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return found.select(*own, edge.alias("edge")).mapInArrow(folded(byte_ids), schema)


def folded(byte_ids: list[int]):
    """Task function: the edges of words, a word's rows one after another and the first with the word's columns -> these
    columns and ids, many words at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def paths() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            first = whole.column("word").is_valid()
            heads = whole.filter(first).drop_columns(["edge"]).combine_chunks()
            words = heads.column("word").to_pylist()
            way, of, starts = cheapest(words, whole.column("edge").to_numpy(), np.cumsum(first.to_numpy()) - 1)
            ids = pa.ListArray.from_arrays(*[pa.array(x, pa.int32()) for x in spelled(words, way, of, starts, byte_ids)])
            columns = [c.chunk(0) for c in heads.columns]
            return pa.RecordBatch.from_arrays([*columns, ids], [*heads.column_names, "ids"])

        for batch in batches:
            if rows >= EDGES:  # up to the last word that begins in this batch
                begun = np.flatnonzero(batch.column(batch.schema.names.index("word")).is_valid().to_numpy(zero_copy_only=False))
                if len(begun):
                    held.append(batch.slice(0, begun[-1]))
                    yield paths()
                    held, rows, batch = [], 0, batch.slice(begun[-1])
            held.append(batch)
            rows += batch.num_rows
        if rows:
            yield paths()

    return run


def cheapest(words: list[str], edges: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, word, start) of the cheapest paths' pieces, in order, from packed edges and the words they are of.

    For each place the least way to it is kept: the cheapest, and of these the one whose last edge starts first.
    """
    size = np.array([len(w) for w in words], np.int64)
    ways = np.full((len(words), WORD + 1), np.iinfo(np.int64).max, np.int64)
    ways[:, 0] = 0
    end, start = edges >> (COST_BITS + LOW), edges >> ID_BITS & 63
    order = np.argsort(end, kind="stable")
    ends = np.searchsorted(end[order], np.arange(WORD + 2))
    for k in range(1, WORD + 1):
        at = order[ends[k]:ends[k + 1]]
        new = (ways[of[at], start[at]] & -(1 << LOW)) + (edges[at] & ((1 << COST_BITS + LOW) - 1))
        to = np.full(len(words), np.iinfo(np.int64).max, np.int64)
        np.minimum.at(to, of[at], new)
        ways[:, k] = to
    found, left, at = [], np.arange(len(words)), size.copy()
    while len(left):
        way = ways[left, at]
        at = way >> ID_BITS & 63
        found.append((way & NO_PIECE, left, at))
        left, at = left[at > 0], at[at > 0]
    ids, own, starts = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((starts, own))
    return ids[order], own[order], starts[order]


def spelled(words: list[str], ids: np.ndarray, of: np.ndarray, starts: np.ndarray, byte_ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(where each word's ids begin, ids): a character without a piece becomes the byte pieces of its UTF-8 form."""
    odd = np.flatnonzero(ids == NO_PIECE)
    in_bytes = [[byte_ids[b] for b in words[of[k]][starts[k]].encode()] for k in odd.tolist()]
    n = np.ones(len(ids), np.int64)
    n[odd] = list(map(len, in_bytes))
    flat = np.repeat(ids, n)
    flat[np.repeat(ids == NO_PIECE, n)] = [k for own in in_bytes for k in own]
    return np.append(0, np.cumsum(np.bincount(of, n, minlength=len(words)).astype(np.int64))), flat


def packed(chunks: int):
    """Task function: (id, text) -> (chunk, rows): texts that stand side by side as one compressed row, dealt to the chunks in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = int(TaskContext.get().partitionId() * 0.6180339887498949 % 1 * chunks)  # tasks begin at places far apart
        for batch in small(batches, PACK_BYTES):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])
            chunk = (chunk + 1) % chunks
        batch = None
        pa.default_memory_pool().release_unused()  # workers are reused, also by others
    return run


def unpacked(rows: pa.BinaryScalar) -> pa.Table:
    """The id and text of one row of ``packed``."""
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def packed_words(pattern: str, ready=None):
    """Task function: (chunk, rows) -> (chunk, word), as ``word_rows``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((chunk, unpacked(rows).column("text").combine_chunks()) for batch in batches for chunk, rows in zip(batch.column(0).to_pylist(), batch.column(1)))
        return word_rows(pattern, ready)(pa.RecordBatch.from_arrays([pa.array(np.full(len(own), chunk, np.int32)), own], ["chunk", "text"]) for chunk, own in texts)
    return run


def word_rows(pattern: str, ready=None):
    """Task function: (chunk, text) -> (chunk, word): the distinct words of the texts at hand, but the ready and the long ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = re.compile(pattern).findall, ready.value[0].keys() if ready else ()
        words: dict[int, set[str]] = {}
        held = 0

        def distinct() -> pa.RecordBatch:
            chunks, found = [], []
            for chunk, own in words.items():
                new = [w for w in (own - known if known else own) if len(w) <= WORD]
                chunks += [chunk] * len(new)
                found += new
            return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(found, pa.string())], ["chunk", "word"])

        for batch in small(batches, CHUNK_BYTES // 2):
            if held and held + batch.nbytes > CHUNK_BYTES // 2:
                yield distinct()
                words, held = {}, 0
            held += batch.nbytes
            for chunk, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if text.is_valid:
                    words.setdefault(chunk, set()).update(cut(" " + text.as_py()))
        if words:
            yield distinct()
    return run


def spelled_words(ids: pa.ListArray, raw: pa.BinaryArray) -> list[str]:
    """The words that lists of pieces spell; ``raw`` has the bytes of every id."""
    if not len(ids):
        return []
    parts = raw.take(ids.values)
    ends = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset:][ids.offsets.to_numpy()]
    return pa.StringArray.from_buffers(len(ids), pa.py_buffer(ends.tobytes()), parts.buffers()[2]).to_pylist()


def frequent_words(rows: DataFrame, pattern: str, table: list[tuple[str, int, int]], byte_ids: list[int]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """({word: place}, ids of all places, where each place's begin) of the FREQUENT commonest words of one document in SAMPLED: at
    most 2^18 words of at most ``WORD`` characters."""
    some = rows.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).select(F.pmod(F.xxhash64("text"), F.lit(1 << 30)).cast("int").alias("chunk"), "text")
    # A word counts once a text, so texts that repeat a rare word don't make it frequent.
    counts = some.mapInArrow(word_rows(pattern), "chunk int, word string").groupBy("word").agg(F.count("*").alias("n"))
    common = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(FREQUENT).select("word")
    spread = written(common, "frequent_words").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")
    found = written(best_paths(spread, [], table, byte_ids), "frequent_paths").toArrow().combine_chunks()
    ids = found["ids"].combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int32()))
    return {w: k for k, w in enumerate(found["word"].to_pylist())}, ids.values.to_numpy(), ids.offsets.to_numpy().astype(np.int64)


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and pieces (array<int>), the ids of the text's pieces.

    A null text has null pieces, an empty one none. Null and repeated ids are passed through, other columns
    ignored. Texts are encoded whole, however long their words.
    """
    table, byte_ids, raw = load_pieces(model)
    pattern, context = cuts(table), docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // CHUNK_BYTES))
    ready = context.broadcast(frequent_words(rows, pattern, table, byte_ids))
    lattice = context.broadcast(({p: (k, c) for p, k, c in table}, max(len(p) for p, _, _ in table), max(c for _, _, c in table) + 1, byte_ids))
    surfaces = context.broadcast(raw)
    dealt = rows.mapInArrow(packed(chunks), "chunk int, rows binary").repartition(chunks, "chunk")
    words = dealt.mapInArrow(packed_words(pattern, ready), "chunk int, word string")
    # A word is encoded once, whatever chunks it is in; one shuffle serves the grouping and the lattice.
    words = words.repartition(F.col("word")).groupBy("word").agg(F.collect_set("chunk").alias("chunks"))
    known = best_paths(words, [], table, byte_ids, ["chunks"]).select(F.explode("chunks").alias("part"), "ids")

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        place, ready_ids, ready_off = ready.value
        ids = right.column("ids").combine_chunks()
        place = place | {w: k for k, w in enumerate(spelled_words(ids, pa.array(surfaces.value, pa.binary())), len(place))}
        own_off = ids.offsets.to_numpy().astype(np.int64)
        off = np.concatenate([ready_off[:-1], own_off[:-1] + len(ready_ids)])
        size = np.concatenate([np.diff(ready_off), np.diff(own_off)])
        flat = np.concatenate([ready_ids, ids.values.to_numpy()])
        long_words: dict[str, np.ndarray] = {}

        def joined(at: list[int]) -> np.ndarray:
            at = np.array(at, np.int64)
            n = size[at]
            return flat[np.arange(int(n.sum())) + np.repeat(off[at] - (np.cumsum(n) - n), n)]

        cut, out, ends, null, done, owners = re.compile(pattern).findall, [], [0], [], 0, [pa.array([], pa.int64())]

        def texts() -> Iterator[str | None]:
            for rows in left.column("rows"):
                own = unpacked(rows)
                owners.append(own.column("id").combine_chunks())
                for text in own.column("text"):
                    yield text.as_py()

        for text in texts():
            null.append(text is None)
            words, first = cut(" " + text) if text else [], len(out)
            at = list(map(place.get, words))
            begin = 0
            for k in [k for k, x in enumerate(at) if x is None] if None in at else ():
                if words[k] not in long_words:
                    long_words[words[k]] = np.array(best_path(words[k], *lattice.value), np.int32)
                out += [joined(at[begin:k]), long_words[words[k]]]
                begin = k + 1
            out.append(joined(at[begin:]))
            done += sum(map(len, out[first:]))
            ends.append(done)
        pieces = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *out]), pa.int32()),
                                          mask=pa.array(null, pa.bool_()) if null else None)
        pa.default_memory_pool().release_unused()
        return pa.table({"id": pa.concat_arrays(owners), "pieces": pieces})

    return (dealt.groupBy("chunk").cogroup(known.groupBy("part"))
            .applyInArrow(put_together, "id long, pieces array<int>").withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, model: str = MODEL, pieces_col: str = "pieces") -> DataFrame:
    """``encoded`` with the column decoded: the text of its pieces (null for null; empty for none)."""
    _, _, raw = load_pieces(model)
    known = encoded.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        for batch in small(batches):
            texts = []
            for ids in batch.column(batch.schema.names.index(pieces_col)):
                ids = ids.values.to_numpy() if ids.is_valid else None
                texts.append(None if ids is None else b"".join([own[k] for k in ids.tolist()])[1:].decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])
        batch = None
        pa.default_memory_pool().release_unused()

    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
