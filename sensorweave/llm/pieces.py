"""Encoding by a piece vocabulary with byte spans of the source, and decoding.

A text is normalised first: at every place the longest prefix that the model's compiled
character map knows is replaced, everything else is copied, and each normalised character
keeps the place in the source it came from. Pieces are then found by merging neighbours,
best score first, within chunks that no piece of the vocabulary crosses; their ends, looked
up among the kept places, are spans of source bytes.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from sensorweave.llm.common import kept_in_worker, slices, whole_text

# The mark that stands for a space, the shown text of an unknown piece,
# the kinds of pieces in a model file and its number for merging models.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGING = 2

#: Bytes, about, that a worker keeps of chunks met before; emptied when full, which changes no result.
CACHE_BYTES = 96 << 20
#: What one entry of that cache takes beside its chunk and numbers.
ENTRY_BYTES = 300
#: Chunks up to this many characters are merged together as arrays; longer ones by a queue.
TOGETHER = 48
#: Characters of text whose new chunks are merged together; a longer text is a group of its own.
GROUP_CHARS = 1 << 20
NO_RANK = np.int32(2**31 - 1)

# The library shows one mark for every byte that is no part of a character.
codecs.register_error("each_byte", lambda error: ("�" * (error.end - error.start), error.end))


class CharacterMap:
    """The replacements of a compiled map: a double array of byte labels over a list of texts."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
        targets = blob[4 + size :]
        self.replacement = {key: targets[at : targets.index(b"\0", at)].decode() for key, at in self._entries(units)}
        lengths: dict[str, set[int]] = {}
        for key in self.replacement:
            lengths.setdefault(key[0], set()).add(len(key))
        self.lengths = {first: sorted(found, reverse=True) for first, found in lengths.items()}

    @staticmethod
    def _entries(units: np.ndarray) -> Iterator[tuple[str, int]]:
        """All keys with their values, level by level of the double array."""
        labels = np.arange(1, 256)
        nodes, keys = np.array([0]), [b""]
        while len(nodes):
            unit = units[nodes]
            base = nodes ^ ((unit >> 10) << ((unit & 512) >> 6))
            for at in np.flatnonzero(unit >> 8 & 1).tolist():
                yield keys[at].decode(), int(units[base[at]] & 0x7FFFFFFF)
            child = base[:, None] ^ labels
            inside = child < len(units)
            real = inside & ((units[np.where(inside, child, 0)] & 0x800000FF) == labels)
            parent, label = np.nonzero(real)
            nodes = child[parent, label]
            keys = [keys[p] + bytes([byte + 1]) for p, byte in zip(parent.tolist(), label.tolist(), strict=True)]

    def longest(self, text: str, at: int) -> tuple[str, int] | None:
        """Replacement and length of the longest known prefix at a place."""
        for length in self.lengths.get(text[at], ()):
            if (found := self.replacement.get(text[at : at + length])) is not None and at + length <= len(text):
                return found, length
        return None


@dataclass
class Encoding:
    """Piece ids of a text with the source bytes of each, from ``begins`` up to before ``ends``."""

    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class Pieces:
    """A merging vocabulary with byte fallback or an unknown piece."""

    def __init__(self, path: str):
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        kinds = {piece.type for piece in spec.pieces}
        if spec.trainer_spec.model_type != MERGING or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merging models of normal, byte, control and unknown pieces are read")
        rules = spec.normalizer_spec
        if spec.trainer_spec.treat_whitespace_as_suffix or not rules.escape_whitespaces:
            raise ValueError("only models that mark a space before its word are read")
        if spec.denormalizer_spec.precompiled_charsmap:
            raise ValueError("models that rewrite decoded text are not read")
        self.prefix, self.squeeze = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        self.map = CharacterMap(rules.precompiled_charsmap) if rules.precompiled_charsmap else None
        starts = set(self.map.lengths if self.map else ()) | ({" "} if self.squeeze else set())
        self.special = re.compile("[" + re.escape("".join(sorted(starts))) + "]") if starts else None

        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        order = {score: rank for rank, score in enumerate(sorted({p.score for p in spec.pieces}, reverse=True))}
        self.ranks = {p.piece: order[p.score] for p in spec.pieces if p.type == NORMAL}
        self._index_pairs()
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        self.fallback = bool(spec.trainer_spec.byte_fallback)
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == UNKNOWN)
        shown = {CONTROL: lambda p: b"", UNKNOWN: lambda p: spec.trainer_spec.unk_surface.encode()}
        shown |= {BYTE: lambda p: bytes([int(p.piece[3:5], 16)]), NORMAL: lambda p: p.piece.replace(MARK, " ").encode()}
        self.shown = [shown[p.type](p) for p in spec.pieces]
        self.leads = [p.type == NORMAL and p.piece.startswith(MARK) for p in spec.pieces]
        self.controls = {i for i, p in enumerate(spec.pieces) if p.type == CONTROL}
        self.digits = [str(i) for i in range(len(spec.pieces))]
        # A piece with a mark behind other characters would cross chunks: then a text is one chunk.
        crossing = any(MARK in piece.lstrip(MARK) for piece in self.ids)
        self.chunks = re.compile("(?s).+" if crossing else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.kept = 0

    def _index_pairs(self) -> None:
        """Pieces that two pieces make together, by the numbers of both."""
        pairs = {}
        for piece, made in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (made, self.ranks[piece])
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        found = [pairs[key] for key in keys.tolist()]
        self.made = np.array([made for made, _ in found] + [0], dtype=np.int32)
        self.made_rank = np.array([rank for _, rank in found] + [NO_RANK], dtype=np.int32)
        self.of_code = np.full(0x110000, -1, dtype=np.int32)
        self.sizes = np.zeros(max(self.ids.values(), default=0) + 1, dtype=np.int32)
        for piece, made in self.ids.items():
            self.sizes[made] = len(piece)
            if len(piece) == 1:
                self.of_code[ord(piece)] = made

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters, and its end, the place of the
        source character it comes from."""
        if self.special is None or not self.special.search(text):
            if not text:
                return "", np.zeros(1, dtype=np.int64)
            places = np.arange(len(text) + 1)
            shown = text.replace(" ", MARK)
            return (MARK + shown, np.concatenate([[0], places])) if self.prefix else (shown, places)
        at, end, first = 0, len(text), 0
        if self.squeeze:
            while at < end and (found := self._prefix(text, at))[0] == " ":
                at += found[1]
            if at == end:
                return "", np.array([end], dtype=np.int64)
            first = at
        parts, places = ([MARK], [np.array([first])]) if self.prefix else ([], [])
        spaced = self.squeeze
        while at < end:
            match = self.special.search(text, at)
            stop = match.start() if match else end
            if stop > at:  # copied as it stands, one character after the other
                parts.append(text[at:stop].replace(" ", MARK))
                places.append(np.arange(at, stop))
                at, spaced = stop, False
                continue
            found, length = self._prefix(text, at)
            if spaced:
                found = found.lstrip(" ")
            if found:
                parts.append(found.replace(" ", MARK))
                places.append(np.full(len(found), at))
                spaced = self.squeeze and found.endswith(" ")
            at += length
        shown, origin = "".join(parts), np.concatenate([*places, [end]])
        if self.squeeze:
            kept = len(shown.rstrip(MARK))
            shown, origin = shown[:kept], origin[: kept + 1]
        return shown, origin

    def _prefix(self, text: str, at: int) -> tuple[str, int]:
        return (self.map and self.map.longest(text, at)) or (text[at], 1)

    def merge(self, chunk: str) -> list[str]:
        """Neighbours whose joint text is a piece are joined, best score first, then leftmost."""
        parts: list[str | None] = list(chunk)
        size, ranks = len(parts), self.ranks
        if size == 1:
            return [chunk]
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        current = [ranks.get(a + b) for a, b in zip(parts, parts[1:])] + [None]
        queue = [rank << 32 | at for at, rank in enumerate(current) if rank is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            at = entry & 0xFFFFFFFF
            if current[at] != entry >> 32:
                continue
            gone = after[at]
            parts[at] += parts[gone]
            parts[gone] = current[gone] = None
            follower = after[at] = after[gone]
            current[at] = None
            if follower < size:
                before[follower] = at
                if (rank := ranks.get(parts[at] + parts[follower])) is not None:
                    current[at] = rank
                    heapq.heappush(queue, rank << 32 | at)
            if (left := before[at]) >= 0:
                current[left] = rank = ranks.get(parts[left] + parts[at])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | left)
        return [part for part in parts if part is not None]

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs among the keys; pairs that make no piece go to the last place."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, at, len(self.keys) - 1)

    def learn_together(self, chunks: list[str]) -> list[tuple[bytes, bytes] | None]:
        """As ``learn`` for many chunks at once: every round joins, in each chunk, the leftmost
        pair of the best score. None where a character is no piece by itself."""
        result: list[tuple[bytes, bytes] | None] = [None] * len(chunks)
        lengths = np.array([len(chunk) for chunk in chunks])
        symbols = self.of_code[np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")]
        owner = np.repeat(np.arange(len(chunks)), lengths)
        strange = np.bincount(owner[symbols < 0], minlength=len(chunks)) > 0
        symbols, owner = symbols[~strange[owner]], owner[~strange[owner]]
        pair = np.full(len(symbols), len(self.keys) - 1)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        pair[inner] = self._pair(symbols[inner], symbols[inner + 1])
        while len(symbols):
            ranks = self.made_rank[pair]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(first, len(symbols)))
            best = np.minimum.reduceat(ranks, first)
            done = best == NO_RANK
            if done.any():
                over = np.repeat(done, sizes)
                raw, places = symbols[over].tobytes(), self.sizes[symbols[over]].tobytes()
                stops = (4 * np.cumsum(sizes[done])).tolist()
                for word, start, stop in zip(owner[first[done]].tolist(), [0, *stops], stops):
                    result[word] = raw[start:stop], places[start:stop]
                symbols, owner, pair, ranks = symbols[~over], owner[~over], pair[~over], ranks[~over]
                best, sizes = best[~done], sizes[~done]
                if not len(symbols):
                    break
            hit = np.flatnonzero(ranks == np.repeat(best, sizes))
            hit = hit[np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])]
            symbols[hit] = self.made[pair[hit]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            symbols, owner, pair = symbols[keep], owner[keep], pair[keep]
            at = hit - np.arange(len(hit))
            changed = np.concatenate([at, at[at > 0] - 1])
            follower = np.minimum(changed + 1, len(symbols) - 1)
            joined = (changed + 1 < len(symbols)) & (owner[changed] == owner[follower])
            found = self._pair(symbols[changed], symbols[follower])
            pair[changed] = np.where(joined, found, len(self.keys) - 1)
        return result

    def learn(self, chunk: str) -> tuple[bytes, bytes]:
        """Ids of a chunk, and how many normalised characters each takes."""
        ids: list[int] = []
        sizes: list[int] = []
        for part in self.merge(chunk):
            if (found := self.ids.get(part)) is not None:
                ids.append(found)
                sizes.append(len(part))
            elif self.fallback:  # the bytes of a character; the last one holds its place
                raw = part.encode()
                ids += [self.bytes[byte] for byte in raw]
                sizes += [0] * (len(raw) - 1) + [len(part)]
            else:
                ids.append(self.unknown)
                sizes.append(len(part))
        return np.array(ids, "<i4").tobytes(), np.array(sizes, "<i4").tobytes()

    def meet(self, chunks: set[str]) -> None:
        short = [chunk for chunk in chunks if len(chunk) <= TOGETHER]
        found = dict(zip(short, self.learn_together(short), strict=True)) if short else {}
        for chunk in chunks:
            numbers = found.get(chunk) or self.learn(chunk)
            self.known[chunk] = numbers
            self.kept += ENTRY_BYTES + 4 * len(chunk) + 2 * len(numbers[0])

    def encode_all(self, texts: list[str]) -> Iterator[Encoding]:
        """Encodings in order; new chunks of about ``GROUP_CHARS`` of text are merged together."""
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= GROUP_CHARS):
                size += len(texts[stop])
                stop += 1
            if self.kept > CACHE_BYTES:
                self.known.clear()
                self.kept = 0
            shown = [self.normalise(text) for text in texts[start:stop]]
            cut = [self.chunks.findall(normal) for normal, _ in shown]
            self.meet(set().union(*cut).difference(self.known))
            for text, (_, origin), chunks in zip(texts[start:stop], shown, cut, strict=True):
                yield self._placed(text, origin, chunks)
            start = stop

    def encode(self, text: str) -> Encoding:
        return next(self.encode_all([text]))

    def _placed(self, text: str, origin: np.ndarray, chunks: list[str]) -> Encoding:
        found = [*map(self.known.__getitem__, chunks)]
        ids = np.frombuffer(b"".join([ids for ids, _ in found]), "<i4")
        stops = np.cumsum(np.frombuffer(b"".join([sizes for _, sizes in found]), "<i4"), dtype=np.int64)
        if not self.fallback:
            ids, stops = self._joined_unknowns(ids, stops)
        if text.isascii():
            places = origin
        else:
            codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
            widths = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
            places = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])[origin]
        edges = places[np.concatenate([[0], stops])]
        return Encoding(ids, edges[:-1], edges[1:])

    def _joined_unknowns(self, ids: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown pieces in a row are one."""
        inner = (ids[:-1] == self.unknown) & (ids[1:] == self.unknown)
        last = np.concatenate([~inner, [True]]) if len(ids) else np.zeros(0, dtype=bool)
        return ids[last], stops[last]

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids. Control pieces show nothing; the space that encoding put in
        front goes, or all spaces in front if the model drops those."""
        front, lead = 0, b""
        if self.prefix or self.squeeze:
            while front < len(ids):
                shown = self.shown[ids[front]]
                marked = self.leads[ids[front]]
                front += 1
                if marked:
                    shown = shown[1:]
                lead += shown
                if shown or (marked and not self.squeeze):
                    break
        if self.controls.isdisjoint(ids):
            return (lead + b"".join(map(self.shown.__getitem__, ids[front:]))).decode("utf-8", "each_byte")
        # A control piece ends a run of bytes, so that they make no character together.
        runs = [bytearray(lead)]
        for i in ids[front:]:
            if i in self.controls:
                runs.append(bytearray())
            else:
                runs[-1] += self.shown[i]
        return "".join(run.decode("utf-8", "each_byte") for run in runs)


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


kept_in_worker("pieces", pieces.cache_clear)


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """Piece ids of every whole text (``ids``), each with its span of source bytes
    (``begins``, ``ends``, the end exclusive).

    ``model`` is the path of the model file on every executor. Null texts count as empty and
    have no pieces; very long texts are encoded whole; repeated rows give repeated results, a
    null id stays null, an empty table gives an empty result, other columns are ignored.
    No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in slices(batches, keep="pieces"):
            found = [*coder.encode_all(batch.column(1).to_pylist())]
            offsets = pa.array(np.cumsum([0] + [len(x.ids) for x in found]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([getattr(x, name) for x in found]), kind))
                for name, kind in (("ids", pa.int32()), ("begins", pa.int64()), ("ends", pa.int64()))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "ids", "begins", "ends"])

    source = docs.select("doc_id", whole_text().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, ids array<int>, begins array<long>, ends array<long>")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """The text of every list of piece ids. A null list gives an empty text; ids outside the
    vocabulary are refused. Repeated rows give repeated results, other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in slices(batches, keep="pieces"):
            texts = [coder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    source = encoded.select("doc_id", "ids")
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, text string")


def encoding_report(docs: DataFrame, model: str) -> DataFrame:
    """Digests of what ``encode_pieces`` and ``decode_pieces`` give for every whole text, in one
    pass: the number of ids, SHA-256 of the ids and of the decoded text, and the source bytes
    that the spans cover. Cases are defined as for ``encode_pieces``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in slices(batches, keep="pieces"):
            rows = []
            for found in coder.encode_all(batch.column(1).to_pylist()):
                ids = found.ids.tolist()
                listed = ",".join(map(coder.digits.__getitem__, ids))
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(listed.encode()).hexdigest(),
                        hashlib.sha256(coder.decode(ids).encode()).hexdigest(),
                        int((found.ends - found.begins).sum()),
                    )
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_covered"],
            )

    source = docs.select("doc_id", whole_text().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_covered long"
    )
