"""Packing of tokenised examples into fixed-length sequences: vector bin packing by the dot-product heuristic."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import text_of

#: Limits of a sequence: tokens, pieces and tokens that bear loss.
MAX_TOKENS, MAX_PIECES, MAX_LOSS = 2048, 256, 2048
#: Pieces that wait for a sequence at a time; a task's memory is bounded by them and one batch of texts.
POOL = 512
END_ID = 1
#: The special string of the vocabulary, with its id, which the library finds in texts by default.
SPECIAL = {"<|endoftext|>": 50256}


def encoder(ranks_path: str, pattern: str, json_path: str):
    """From a text to its ids, those of the library that reads json_path.

    The same byte-level vocabulary as ranks gives them several times as fast; its pattern gives up on very long runs of one kind of character (about 10^6 blanks), and such a text is
    encoded by the library itself, which is loaded then.
    """
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
    coder, slow = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL), []

    def ids_of(text: str) -> np.ndarray:
        try:
            return coder.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(json_path))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return lambda text: np.append(ids_of(text), np.uint32(END_ID)).astype("<u4")


def _power(n: int) -> int:
    """The largest power of two up to n."""
    return 1 << (n.bit_length() - 1)


class Packer:
    """Fills one sequence at a time from a pool of pieces.

    An item is a vector: its tokens, 1 piece, its loss-bearing tokens, each as a share of its limit. The next item is the one that fits and whose
    product with the room left is largest. If none fits, the item of the largest product is cut to the room. A sequence that reaches its limit of pieces or of loss-bearing
    tokens first is closed at the largest power of two below, which needs no padding; what stands beyond goes back to the pool.
    """

    def __init__(self, first_sequence: int, max_tokens: int = MAX_TOKENS, max_pieces: int = MAX_PIECES, max_loss: int = MAX_LOSS):
        if min(max_tokens, max_pieces, max_loss) < 1:
            raise ValueError("limits start at 1")
        self.limits = np.array([max_tokens, max_pieces, max_loss], float)
        self.next, self.items, self.out = first_sequence, [], []
        self.size = np.zeros((0, 3))

    def add(self, row: int, ids: np.ndarray, bears_loss: bool) -> None:
        """A whole example; full sequences are cut off at once, its rest waits."""
        start, step = 0, int(self.limits[0])
        if bears_loss and self.limits[2] < step:
            step = _power(int(self.limits[2]))
        while len(ids) - start >= step:
            self._emit(self.next, 0, row, ids, start, step)
            self.next, start = self.next + 1, start + step
        if start < len(ids):
            self.items.append((row, ids, start, bears_loss))
            if len(self.items) >= 2 * POOL:
                self.fill(POOL)

    def _emit(self, sequence: int, offset: int, row: int, ids: np.ndarray, start: int, length: int) -> None:
        self.out.append((row, start, length, zlib.crc32(ids[start : start + length]), len(ids), sequence, offset, ids[start : start + length]))

    def fill(self, leave: int) -> None:
        """Fill sequences until at most `leave` pieces wait; with 0, all are placed."""
        items = self.items
        size = np.array([(len(ids) - start, 1, (len(ids) - start) * bears) for _, ids, start, bears in items], float).reshape(-1, 3)
        alive = np.ones(len(items), bool)
        left = len(items)
        while left > leave:
            if not leave and size[alive, 0].sum() < self.limits[0]:
                self._last([items[i] for i in np.flatnonzero(alive)])
                alive[:] = False
                break
            room, offset, placed = self.limits.copy(), 0, []
            while room[0] and room[1] and alive.any():
                fits = alive & (size <= room).all(axis=1)
                chosen = np.where(fits if fits.any() else alive, (size / self.limits) @ (room / self.limits), -1.0)
                i = int(chosen.argmax())
                row, ids, start, bears = items[i]
                take = int(min(size[i, 0], room[0], room[2] if bears else room[0]))
                if take == 0:
                    others = alive & (size[:, 2] == 0)
                    if not others.any():
                        break
                    i = int(np.where(others, size[:, 0], -1.0).argmax())
                    row, ids, start, bears = items[i]
                    take = int(min(size[i, 0], room[0]))
                placed.append((i, start, take))
                offset += take
                room -= (take, 1, take * bears)
                items[i] = (row, ids, start + take, bears)
                size[i] -= (take, 0, take * bears)
                if size[i, 0] == 0:
                    alive[i], left = False, left - 1
            back = offset - _power(offset) if room[0] else 0
            while back:
                i, start, take = placed.pop()
                row, ids, _, bears = items[i]
                keep = max(0, take - back)
                back -= take - keep
                if not alive[i]:
                    alive[i], left = True, left + 1
                items[i] = (row, ids, start + keep, bears)
                size[i] = (len(ids) - start - keep, 1, (len(ids) - start - keep) * bears)
                if keep:
                    placed.append((i, start, keep))
            offset = 0
            for i, start, take in placed:
                row, ids, _, _ = items[i]
                self._emit(self.next, offset, row, ids, start, take)
                offset += take
            self.next += 1
        self.items = [items[i] for i in np.flatnonzero(alive)]

    def _last(self, items: list) -> None:
        """What is left for less than one sequence goes into sequences as long as powers of two, which need no padding.

        Pieces that bear loss and those that don't have sequences of their own here, those of the former no longer than the limit on loss-bearing tokens.
        """
        for bears in (True, False):
            own = [(row, ids, start) for row, ids, start, b in items if b == bears]
            left, most = sum(len(ids) - start for _, ids, start in own), int(min(self.limits[0], self.limits[2] if bears else self.limits[0]))
            sizes = [len(ids) - start for _, ids, start in own]
            room = offset = 0
            for n, (row, ids, start) in enumerate(own):
                while start < len(ids):
                    if not room:
                        self.next += bool(offset)
                        # No longer than the next pieces, as many as one sequence takes: so it is filled.
                        near = len(ids) - start + sum(sizes[n + 1 : n + int(self.limits[1])])
                        room, offset = _power(min(left, most, near)), 0
                    take = min(room, len(ids) - start)
                    self._emit(self.next, offset, row, ids, start, take)
                    start, left, room, offset = start + take, left - take, room - take, offset + take
            self.next += bool(offset)

    def drain(self) -> list:
        out, self.out = self.out, []
        return out


def pack(docs: DataFrame, ranks_path: str, pattern: str, json_path: str, id_col: str = "doc_id", text_col: str = "text", loss_col: str | None = None, max_tokens: int = MAX_TOKENS, max_pieces: int = MAX_PIECES, max_loss: int = MAX_LOSS, with_ids: bool = False) -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, the ids themselves.

    An example is the ids of its text and one end id; a null text is empty, so it is the end id alone. loss_col (boolean, null: true) says whether
    its tokens bear loss. Rows that repeat an id are packed each on its own. Extra columns are not read. Texts of any length and kind are encoded whole: ids are
    those of the library that reads json_path (see encoder).

    Each task packs the rows of its own input split, in their order, from a pool of bounded size: nothing is shuffled, and a task that is
    run again gives the same sequences. Numbers of sequences start at the task's partition number times 2^36.
    """
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, packer, known, n = encoder(ranks_path, pattern, json_path), Packer(TaskContext.get().partitionId() << 36, max_tokens, max_pieces, max_loss), {}, 0

        def placed() -> pd.DataFrame:
            pieces = packer.drain()
            frame = pd.DataFrame({c: [p[i + 1] for p in pieces] for i, c in enumerate(names)})
            frame.insert(0, id_col, pd.Series([known[p[0]] for p in pieces], dtype=object))
            if with_ids:
                frame["ids"] = [p[7].astype("int64") for p in pieces]
            waiting = {i[0] for i in packer.items}
            for k in [k for k in known if k not in waiting]:
                del known[k]
            return frame

        for b in batches:
            for key, text, loss in zip(b["_id"].astype(object).where(b["_id"].notna(), None), b["_text"], b["_loss"]):
                known[n] = key
                packer.add(n, encode(text), bool(loss))
                n += 1
                if len(packer.out) >= 20_000:
                    yield placed()
        packer.fill(0)
        yield placed()

    loss = F.coalesce(F.col(loss_col), F.lit(True)) if loss_col else F.lit(True)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"), loss.alias("_loss"))
    kind = dict(docs.dtypes)[id_col]
    return rows.mapInPandas(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in names) + ", ids array<long>" * with_ids)
