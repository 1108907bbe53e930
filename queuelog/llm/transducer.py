"""SentencePiece encoding as a shortest path through a weighted transducer, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog.llm import pieces
from queuelog.llm.common import kept, table

#: Recent words whose encodings a task keeps (twice), the longest word it keeps, and characters composed at a time.
CACHE, KEEP, SLAB = 200_000, 64, 1_000_000
#: Slots for verdicts of the acceptor (a power of two), and verdicts kept for long parts.
SLOTS, VERDICTS = 1 << 20, 250_000
#: Steps that all parts take together; what is longer goes on alone.
TOGETHER = 256
CHUNK = re.compile(f"{pieces.SPACE}*[^{pieces.SPACE}]+|{pieces.SPACE}+")
NEVER = -np.inf


class Transducer:
    """Characters to piece ids, for a byte-pair model with byte fallback.

    Four machines over the tropical semiring, compiled to arrays and composed with the text as it is read:

    - the normaliser writes a space mark before the text and one for every space (``normal``);
    - the piece machine is a trie: its arcs read a piece's characters and write its id at a weight of
      minus its score (``trie``, ``cost``);
    - byte fallback reads a character that no piece has and writes its bytes, at a higher weight than
      any piece; no piece spans such a character;
    - the merge acceptor holds the last id as its state and lets the next one pass, at weight 0, only if
      merging the characters of both by score gives back just these two (``accepted``); else the
      weight is infinite. A path all of whose neighbours pass is the model's own encoding.

    ``shortest`` relaxes (weight, back pointer) once per position, for all parts of many words at a
    time. Pieces have the space mark at their start only, apart from runs of marks, so a text may be cut
    before every mark that follows another character, and between two characters that stand side by side in no piece.
    """

    def __init__(self, path: str = pieces.MODEL):
        self.model = pieces.load(path)
        ids, size = self.model.ids, self.model.size
        self.whole = any(pieces.SPACE in p.lstrip(pieces.SPACE) for p in ids)
        self.normal = np.arange(0x110000, dtype=np.uint32)
        self.normal[ord(" ")] = ord(pieces.SPACE)
        self.trie = pieces.Trie(ids)
        self.score = np.full(size, NEVER)
        self.score[list(ids.values())] = [self.model.scores[p] for p in ids]
        self.cost = np.append(-np.where(self.score > NEVER, self.score, 0), 0)
        self.cost[-1] = self.cost.max() + 10  # of bytes, id -1
        letter = self.trie.letter
        inside = {int(letter[ord(a)]) * self.trie.size + int(letter[ord(b)]) for p in ids for a, b in zip(p, p[1:])}
        self.inside = pieces.Numbers(np.array(sorted(inside), np.int64), np.ones(len(inside), bool), False)
        self.alone = np.zeros(self.trie.size + 1, bool)  # characters that are pieces; others go by bytes
        self.alone[[letter[ord(p)] for p in ids if len(p) == 1]] = True
        self._compile(ids, size)
        output = [b""] * size
        for p, i in ids.items():
            output[i] = p.replace(pieces.SPACE, " ").encode()
        for b, i in enumerate(self.model.bytes_):
            if i >= 0:
                output[i] = bytes([b])
        self.output = pa.array(output, pa.large_binary())
        self.done: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.verdicts: dict[tuple[int, int], bool] = {}
        self.asked, self.said = np.full(SLOTS, -1), np.zeros(SLOTS, bool)
        self.odd: dict[tuple[int, int], bool] = {}

    def _compile(self, ids: dict[str, int], size: int) -> None:
        """The merge acceptor: what stands at either end of a piece while it is merged, and the scores of
        pairs that merge."""
        sides: dict[str, tuple[str, str]] = {}
        for p in sorted(ids, key=len):
            parts, last = self.merged(p)
            sides[p] = last if parts == [p] else ("", "")
        self.own = np.zeros(size + 1, bool)  # merging makes the piece
        self.own[[ids[p] for p in ids if len(p) == 1 or sides[p][0]]] = True

        def spine(piece: str, side: int) -> list[int] | None:
            """Symbols from the first character to the piece; None unless merged in the order of scores."""
            out = [piece]
            while len(out[-1]) > 1:
                below = sides[out[-1]][side]
                if not below or len(below) > 1 and self.model.scores[below] <= self.model.scores[out[-1]]:
                    return None
                out.append(below)
            return [ids.get(x, -1) for x in out[::-1]]

        self.name = {i: p for p, i in ids.items()}
        self.spines, self.depth = [], []
        self.plain = np.ones(size + 1, bool)
        for side in (1, 0):
            found = {i: spine(p, side) for p, i in ids.items()}
            deep = max((len(x) for x in found.values() if x), default=1)
            table_, depth = np.full((size + 1, deep + 1), -1, np.int32), np.zeros(size + 1, np.int32)
            for i, x in found.items():
                if x is None or -1 in x:
                    self.plain[i] = False
                else:
                    table_[i, : len(x)], depth[i] = x, len(x)
            self.spines.append(table_)
            self.depth.append(depth)
        pairs = sorted((ids[p[:n]] * size + ids[p[n:]], self.model.scores[p]) for p in ids for n in range(1, len(p)) if p[:n] in ids and p[n:] in ids)
        self.pairs = pieces.Numbers(np.array([k for k, _ in pairs], np.int64), np.array([x for _, x in pairs], float), NEVER)
        self.score = np.append(self.score, NEVER)  # of no symbol, -1

    def merged(self, text: str) -> tuple[list[str], tuple[str, str]]:
        """What merging neighbours, best score first and leftmost among equals, makes of ``text``;
        and the two sides of the last merge."""
        parts, sides = list(text), ("", "")
        while len(parts) > 1:
            joined = list(map(str.__add__, parts, parts[1:]))
            best = max((j for j in joined if j in self.model.ids), key=self.model.scores.__getitem__, default=None)
            if best is None:
                break
            at = joined.index(best)
            sides = parts[at], parts[at + 1]
            parts[at : at + 2] = [best]
        return parts, sides

    def passes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``accepted``, with recent verdicts kept: a pair's place is a hash of it."""
        pair = (left + 1) * (self.model.size + 1) + right + 1
        slot = (pair * 0x9E3779B1 >> 7) & (SLOTS - 1)
        new = np.flatnonzero(self.asked[slot] != pair)
        ok = self.said[slot]
        if len(new):
            ok[new] = self.accepted(left[new], right[new])
            # pairs that share a place in one call: the last one is kept, key and verdict alike
            where = slot[new]
            self.asked[where] = pair[new]
            keep = new[self.asked[where] == pair[new]]
            self.said[slot[keep]] = ok[keep]
        return ok

    def accepted(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merge acceptor goes from ``left`` (-1: nothing, or bytes) to ``right``: no merge
        across the border comes before those that change the symbols on either side of it."""
        ok = np.where(right >= 0, self.own[right], True)
        both = (left >= 0) & (right >= 0)
        odd = both & ~(self.plain[left] & self.plain[right])
        for k in np.flatnonzero(odd):
            key = int(left[k]), int(right[k])
            if key not in self.odd:
                names = [self.name[key[0]], self.name[key[1]]]
                self.odd[key] = self.merged("".join(names))[0] == names
            ok[k] = self.odd[key]
        open_ = np.flatnonzero(both & ~odd)
        a, b = left[open_], right[open_]
        i, j = np.zeros(len(open_), np.int32), np.zeros(len(open_), np.int32)
        (ends, begins), size = self.spines, self.model.size
        while len(open_):
            across = self.pairs.get(ends[a, i].astype(np.int64) * size + begins[b, j])
            next_a, next_b = self.score[ends[a, i + 1]], self.score[begins[b, j + 1]]
            no = (across > next_a) & (across >= next_b)
            end = no | (next_a == NEVER) & (next_b == NEVER)
            ok[open_[end]] = ~no[end]
            turn, go = next_a >= next_b, ~end
            open_, a, b, i, j = open_[go], a[go], b[go], (i + turn)[go], (j + ~turn)[go]
        return ok

    def shortest(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids on the shortest path of every word, one after the other, and how many each has. Words are
        composed with the machines side by side; in step t every part relaxes its arcs that end at t."""
        codes = self.normal[pieces.codes_of("".join(words))]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = self.trie.letter[codes]
        n = len(letters)
        # parts: where a word begins, and between characters that no piece holds side by side
        fresh = np.ones(n, bool)
        if n > 1:
            pair = letters[:-1].astype(np.int64) * self.trie.size + letters[1:]
            fresh[1:] = ~self.inside.get(np.maximum(pair, 0)) | (letters[:-1] < 0) | (letters[1:] < 0)
        begins = np.cumsum(sizes) - sizes
        fresh[begins[sizes > 0]] = True
        starts = np.flatnonzero(fresh)
        part = np.cumsum(fresh) - 1
        ends = np.append(starts[1:], n)[part] if n else part
        source, target, piece = self.trie.arcs(letters, ends)
        raw = np.flatnonzero(~self.alone[letters])
        source, target = np.concatenate([source, raw]), np.concatenate([target, raw + 1])
        piece = np.concatenate([piece, np.full(len(raw), -1)]).astype(np.int64)
        # positions of part k lie k further on, since each part has one more than it has characters
        own = part[source]
        step = target - starts[own]
        short = len(step) and step.max() < 1 << 15
        order = np.argsort(step.astype(np.int16) if short else step, kind="stable")
        source, target, piece, step = (source + own)[order], (target + own)[order], piece[order], step[order]
        weight, back = np.full(n + len(starts), np.inf), np.full(n + len(starts), -1)
        last = np.full(n + len(starts), -1)
        weight[starts + np.arange(len(starts))] = 0
        cuts = np.searchsorted(step, np.arange(1, min(TOGETHER, int(step.max(initial=0))) + 2))
        for lo, hi in zip(cuts, cuts[1:]):
            at = lo + np.flatnonzero(self.passes(last[source[lo:hi]], piece[lo:hi]))
            to, total = target[at], weight[source[at]] + self.cost[piece[at]]
            weight[to] = total
            if not (weight[to] == total).all():  # several to one position: the least is written last
                first = np.argsort(-total, kind="stable")
                at, to, total = at[first], to[first], total[first]
                weight[to] = total
            back[to], last[to] = at, piece[at]
        if cuts[-1] < len(step):
            self._alone(int(cuts[-1]), source, target, piece, weight, back, last)
        here = np.append(starts[1:], n) + np.arange(len(starts)) if n else np.empty(0, np.int64)
        if len(here) and not np.isfinite(weight[here]).all():
            raise ValueError("a text has no path")
        used, first = [], starts + np.arange(len(starts))
        while len(here):  # back along the pointers, all parts at once
            arc = back[here]
            used.append(arc)
            here, first = source[arc], first
            go = here > first
            here, first = here[go], first[go]
        arcs = np.concatenate(used) if used else np.empty(0, np.int64)
        arcs = arcs[np.argsort(target[arcs], kind="stable")]
        ids, place = piece[arcs], source[arcs]
        # a position less its part's number is the character's
        shift = np.searchsorted(starts + np.arange(len(starts)), place, "right") - 1
        place = place - shift
        if (ids < 0).any():
            spelled = [self._fallback(codes[p]) if i < 0 else (i,) for i, p in zip(ids.tolist(), place.tolist())]
            place = np.repeat(place, list(map(len, spelled)))
            ids = np.array([i for x in spelled for i in x], np.int64)
        bounds = np.searchsorted(place, np.append(begins, n))
        return ids.astype(np.int32), np.diff(bounds)

    def _alone(self, at: int, source, target, piece, weight, back, last) -> None:
        """The same relaxation arc by arc, for the rest of parts so long that few are left."""
        verdicts, cost = self.verdicts, self.cost.tolist()
        reached, states = weight.tolist(), last.tolist()
        for k, s, t, p in zip(range(at, len(source)), source[at:].tolist(), target[at:].tolist(), piece[at:].tolist()):
            total = reached[s] + cost[p]
            if total < reached[t]:
                pair = states[s], p
                ok = verdicts.get(pair)
                if ok is None:
                    if len(verdicts) > VERDICTS:
                        verdicts.clear()
                    ok = verdicts[pair] = bool(self.accepted(np.array([pair[0]]), np.array([p]))[0])
                if ok:
                    reached[t], states[t], back[t] = total, p, k
        weight[:], last[:] = reached, states

    def _fallback(self, code: int) -> list[int]:
        raw = [self.model.bytes_[b] for b in chr(code).encode("utf-8", "surrogatepass")]
        return [self.model.unknown] if min(raw) < 0 else raw

    def learn(self, keys: list[str]) -> None:
        """Encodings of words; a key that starts with a space holds its own marks behind it."""
        at = 0
        while at < len(keys):
            size, first = 0, at
            while at < len(keys) and (at == first or size + len(keys[at]) < SLAB):
                size += len(keys[at])
                at += 1
            own = keys[first:at]
            ids, counts = self.shortest([k[1:] if k[0] == " " else pieces.SPACE + k for k in own])
            raw, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            self.done.update((k, raw[a:b]) for k, a, b in zip(own, [0, *ends], ends))

    def _keys(self, text: str) -> list[str]:
        if not text:
            return []
        if self.whole or "  " in text or pieces.SPACE in text or text[0] == " " or text[-1] == " ":
            marked = pieces.SPACE + text.replace(" ", pieces.SPACE)
            return [" " + c for c in ([marked] if self.whole else CHUNK.findall(marked))]
        return text.split(" ")

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (int32)."""
        keys = [self._keys(t) for t in texts]
        used = set().union(*keys)
        if len(self.done) > CACHE:  # words not met since go
            self.done, self.before = {}, self.done
        missing = used.difference(self.done)
        again = missing.intersection(self.before)
        self.done.update(zip(again, map(self.before.__getitem__, again)))
        missing = list(missing - again)
        self.learn(missing)
        out = [np.frombuffer(b"".join(map(self.done.__getitem__, own)), np.int32) for own in keys]
        for k in missing:
            if len(k) > KEEP:
                del self.done[k]
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode_all(self, ids: np.ndarray, ends: list[int]) -> list[str]:
        """Texts of consecutive runs of ids: outputs joined, the first space, which encoding put there, left out."""
        found = self.output.take(pa.array(ids))
        offsets = np.frombuffer(found.buffers()[1], np.int64)[: len(ids) + 1]
        raw = memoryview(found.buffers()[2] or b"")
        cuts = offsets[np.array(ends)].tolist()
        return [str(raw[a:b], "utf-8", "replace").removeprefix(" ") for a, b in zip(cuts, cuts[1:])]


def transducer(path: str) -> Transducer:
    """One per Python worker."""
    return kept(path, lambda: Transducer(path))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(list(map(len, rows)), dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32)))


def _ids(machine: Transducer, texts: pa.Array) -> pa.Array:
    found = texts.to_pylist()
    made = _lists(machine.encode_all([t or "" for t in found]))
    return pc.if_else(pa.array([t is None for t in found]), pa.scalar(None, made.type), made)


def _texts(machine: Transducer, ids: pa.Array) -> pa.Array:
    values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_pylist()
    texts = machine.decode_all(values, ends)
    return pa.array([t if ok else None for t, ok in zip(texts, ids.is_valid().to_pylist())], pa.string())


def encode(docs: DataFrame, *, path: str = pieces.MODEL, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>, null for a null text, empty for an empty one).

    The ids are those of the public model's own encoding. Texts are whole, whatever their length.
    Rows, repeated ones too, and other columns are kept; a column named ``ids`` is replaced.
    """
    rest = [c for c in docs.columns if c != "ids"]
    at = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            ids = _ids(transducer(path), part.column(at))
            yield pa.RecordBatch.from_arrays([*part.columns, ids], [*rest, "ids"])

    return docs.select(*rest).mapInArrow(run, docs.select(*rest).schema.add("ids", T.ArrayType(T.IntegerType())))


def decode(rows: DataFrame, *, path: str = pieces.MODEL, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids``; null for null."""
    rest = [c for c in rows.columns if c != "decoded"]
    at = rest.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays([*part.columns, _texts(transducer(path), part.column(at))], [*rest, "decoded"])

    return rows.select(*rest).mapInArrow(run, rows.select(*rest).schema.add("decoded", "string"))


def encode_and_check(docs: DataFrame, *, path: str = pieces.MODEL, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``round_trip``, whether decoding them gives the text (true for null), in
    place of the text. Both ways run in one worker, so text and ids cross to Spark once."""
    rest = [c for c in docs.columns if c not in (text, "ids", "round_trip")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            machine, texts = transducer(path), part.column(len(rest))
            ids = _ids(machine, texts)
            same = pc.fill_null(pc.equal(_texts(machine, ids), texts), True)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, same], [*rest, "ids", "round_trip"])

    schema = docs.select(*rest).schema.add("ids", T.ArrayType(T.IntegerType())).add("round_trip", "boolean")
    return docs.select(*rest, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 128):
            yield batch.slice(start, 128)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_and_check(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "round_trip")
