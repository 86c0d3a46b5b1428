"""Packing documents into sequences of at most ``capacity`` tokens.

A document is its token ids and an end id.  A longer one is cut into pieces of
``capacity`` tokens, the first of which may be shorter.  What has to be packed
is then only a histogram of piece lengths, at most ``capacity`` numbers however
many documents there are.

1. The configuration LP over the histogram (a variable for each way to fill a
   sequence) is solved approximately by multiplicative weights.  Uncovered
   lengths gain weight; a knapsack dynamic programme prices the best filling
   for each length, and all near-best columns grow together.
2. The solution is rounded to whole sequences, the fullest columns first and
   up as far as pieces are left; what remains is placed by best fit, longest
   first.
3. Pieces are numbered within their length, in salted groups, and a number is
   looked up in the plan, which gives sequence and offset.

Defined cases: null and empty texts are the end id alone; repeated rows are
packed each; an empty table gives an empty result; other columns are never
read.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import ship, staged

END_ID = 0
ROUNDS = 150
#: A column grows when its price is within this of the best.
SLACK = 0.03
#: Share of a length's demand that one round may cover.
STEP = 0.1
#: How fast the weight of a length falls as its demand is covered.
RATE = 10.0
#: Groups that one length is dealt to when its pieces are numbered.
SALT = 256


@lru_cache(maxsize=2)
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], bytes]:
    """Text to ids (little-endian unsigned 32-bit) as the tokenizer file at ``path`` gives them.

    A byte-level vocabulary whose ids stand in merge order is encoded by
    tiktoken, which gives the same ids several times faster; any other one, and
    texts on which its pattern gives up, by the tokenizers library itself.
    """
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    ranks = _merge_ranks(content["model"])

    def by_library(text: str) -> bytes:
        return np.array(_library(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    if ranks is None or content["normalizer"] is not None or content["pre_tokenizer"] != BYTE_LEVEL:
        return by_library
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    coder = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> bytes:
        try:
            return coder.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4").tobytes()
        except ValueError:  # the pattern gives up on white space of hundreds of thousands of characters
            return by_library(text)

    return encode


#: The splitting pattern of byte-level BPE and how a file names it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _merge_ranks(model: dict) -> dict[bytes, int] | None:
    """Bytes to id, if each merge makes the id that follows the one before; else None."""
    vocab, of = model["vocab"], byte_letters()
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if made != list(range(256, 256 + len(made))) or model.get("end_of_word_suffix"):
        return None
    return {bytes(of[c] for c in token): i for token, i in vocab.items() if i < 256 + len(made)}


def pieces(
    docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", capacity: int = 2048, with_ids: bool = False
) -> DataFrame:
    """One row a piece: id, piece, start, length, ids_crc32, and the ids themselves if wanted."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(vocabulary), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, body in zip(batch["id"], batch["text"]):
                ids = (encode(body) if body else b"") + end
                n = len(ids) // 4
                stop, start = n % capacity or capacity, 0
                for piece in range(-(-n // capacity)):
                    part = ids[4 * start : 4 * stop]
                    row = (doc, piece, start, stop - start, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if with_ids else row)
                    start, stop = stop, stop + capacity
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"id": "Int64"})

    names = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInPandas(_whole_ids(cut), schema)


def _whole_ids(cut):
    """Ids with nulls reach pandas as floats; the cut sees them as nullable integers."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from cut(b.assign(id=b["id"].astype("Int64")) for b in batches)

    return apply


def _price(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room the best total value, and the index of the length taken first (-1: leave one token free)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fits[room]:
            total = value[: fits[room]] + best[room - lengths[: fits[room]]]
            top = int(total.argmax())
            if total[top] > best[room]:
                best[room], pick[room] = total[top], top
    return best, pick


def configuration_lp(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> dict[tuple[int, ...], float]:
    """Fillings (indices of lengths, sorted) and how often each is used, covering nearly all demand."""
    weight, covered = np.ones(len(lengths)), np.zeros(len(lengths))
    used: dict[tuple[int, ...], float] = {}
    for _ in range(ROUNDS):
        open_ = covered < 1 - 1e-9
        if not open_.any():
            break
        value = np.where(open_, weight / demand, 0.0)
        value /= value.max()
        best, pick = _price(lengths, value, capacity)
        worth = np.where(open_, value + best[capacity - lengths], 0.0)
        columns = np.flatnonzero(worth >= (1 - SLACK) * worth.max())
        fillings = [[i] for i in columns]
        for filling, room in zip(fillings, capacity - lengths[columns]):
            while room > 0:
                if pick[room] < 0:
                    room -= 1
                else:
                    filling.append(int(pick[room]))
                    room -= lengths[pick[room]]
        amount = STEP * demand[columns]
        gain = np.zeros(len(lengths))
        for filling, x in zip(fillings, amount):
            for i in filling:
                gain[i] += x
        scale = STEP / (gain / demand).max()
        gain *= scale / demand
        for filling, x in zip(fillings, amount * scale):
            key = tuple(sorted(map(int, filling)))
            used[key] = used.get(key, 0.0) + x
        covered += gain
        weight *= np.exp(-RATE * gain)
    return used


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, of all pieces that are left; equal sequences stay together."""
    by_room: dict[int, list[list]] = {}
    rooms = np.zeros(capacity + 1, bool)
    for i in range(len(lengths) - 1, -1, -1):
        size, n = int(lengths[i]), int(left[i])
        while n:
            found = np.flatnonzero(rooms[size:])
            if not len(found):
                each = capacity // size
                for per, count in ((each, n // each), (n % each, 1)):
                    if per and count:
                        _add(by_room, rooms, capacity - per * size, [(i,) * per, count])
                break
            room = size + int(found[0])
            group = by_room[room][-1]
            fit = min(room // size, n)
            count = min(group[1], n // fit)
            _add(by_room, rooms, room - fit * size, [group[0] + (i,) * fit, count])
            group[1] -= count
            n -= count * fit
            if not group[1]:
                by_room[room].pop()
                rooms[room] = bool(by_room[room])
    return [(tuple(f), c) for groups in by_room.values() for f, c in groups]


def _add(by_room, rooms, room, group):
    by_room.setdefault(room, []).append(group)
    rooms[room] = True


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Fillings as lists of lengths, and how many sequences are filled so; together they hold every piece."""
    out = []
    if histogram.get(capacity):
        out.append(([capacity], histogram[capacity]))
    lengths = np.array(sorted(x for x in histogram if x < capacity and histogram[x]), np.int64)
    if not len(lengths):
        return out
    left = np.array([histogram[int(x)] for x in lengths], np.int64)
    used = configuration_lp(lengths, left.astype(float), capacity)
    left, chosen = left.copy(), []
    room = {f: capacity - int(sum(lengths[i] for i in f)) for f in used}
    for filling, amount in sorted(used.items(), key=lambda x: (room[x[0]], -x[1], x[0])):
        kinds, per = np.unique(filling, return_counts=True)
        times = min(math.ceil(amount), int((left[kinds] // per).min()))
        if times > 0:
            left[kinds] -= per * times
            chosen.append((filling, times))
    chosen += _best_fit(lengths, left, capacity)
    return out + [([int(lengths[i]) for i in f], n) for f, n in chosen]


class Layout:
    """Looks up the sequence and offset of the k-th piece of a length."""

    def __init__(self, fillings: list[tuple[list[int], int]]):
        runs, taken, sequence = [], {}, 0
        for filling, times in fillings:
            offset = 0
            for length in filling:
                first = taken.get(length, 0)
                runs.append((length, first, sequence, offset))
                taken[length] = first + times
                offset += length
            sequence += times
        runs.sort()
        table = np.array(runs, np.int64).reshape(-1, 4)
        self.length, self.first, self.sequence, self.offset = table.T.copy()
        self.begin = dict(zip(*[x.tolist() for x in np.unique(self.length, return_index=True)])) if len(table) else {}
        self.sequences = sequence

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for size in np.unique(length):
            rows = length == size
            low = self.begin[int(size)]
            high = np.searchsorted(self.length, size, "right")
            run = low + np.searchsorted(self.first[low:high], rank[rows], "right") - 1
            sequence[rows] = self.sequence[run] + rank[rows] - self.first[run]
            offset[rows] = self.offset[run]
        return sequence, offset


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """``parts`` (id, piece, length and what else it has) with sequence_id and offset.

    ``parts`` should be a stored table: it is read for the histogram and again
    for the numbers.
    """
    spark = parts.sparkSession
    # at most ``capacity`` rows
    histogram = {int(r[0]): int(r[1]) for r in parts.groupBy("length").count().collect()}
    shared = spark.sparkContext.broadcast(Layout(plan(histogram, capacity)))
    dealt = parts.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(SALT)).cast("int"))
    sizes = dealt.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    # at most capacity * SALT rows
    begins = staged(sizes.select("length", "salt", before.alias("before")), "begins")
    turn = Window.partitionBy("length", "salt").orderBy("id", "piece")
    ranked = (
        dealt.withColumn("turn", F.row_number().over(turn) - 1)
        .join(begins, ["length", "salt"])
        .withColumn("sequence_id", (F.col("before") + F.col("turn")).cast("long"))
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("salt", "turn", "before")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = shared.value.place(batch["length"].to_numpy(), batch["sequence_id"].to_numpy())
            batch["sequence_id"], batch["offset"] = sequence, offset
            yield batch.astype({"id": "Int64"})

    return ranked.mapInPandas(place, ranked.schema)
