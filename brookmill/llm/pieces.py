"""Merge-type subword encoding by backtracking, and decoding.

A merge encoder joins the best-scored adjacent pair again and again. Its result is the only sequence of
pieces in which every two neighbours are *compatible*: merging their joint text from its characters
gives these two pieces again. So the encoder walks left to right, takes the longest piece that an Aho-Corasick
automaton finds at a place, keeps it if it is compatible with its predecessor, else tries the next shorter
one, and goes back one piece when none is left. Places from which no way leads on are marked in a bitfield and
never tried twice: the work is linear in the text.

A text is first cut where no merge can happen: after words and marks, between two characters that stand side by side in
no piece. Such units repeat, so their encodings are kept in a bounded cache.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType
from sentencepiece import SentencePieceProcessor

from brookmill.llm.common import Rows, hexdigest, map_batches

SPACE = "▁"
CACHED_UNITS = 200_000
CACHED_PAIRS = 400_000
CACHED_CHARS = 64
REPLACEMENT = "�"
RUN = f"(?:{SPACE}*[^\\W_]+|{SPACE}+|[^{SPACE}])"


def any_of(characters: Iterable[str]) -> str:
    return f"[{''.join(map(re.escape, sorted(set(characters))))}]"


def units_pattern(joined: set[str]) -> re.Pattern[str]:
    """Units of a text: runs of word characters, spaces and marks, with what follows where the two characters at the border are ``joined``."""
    border = defaultdict(list)
    for pair in joined:
        if len(re.findall(RUN, pair)) > 1:
            border[pair[0]].append(pair[1])
    if not border:
        return re.compile(RUN)
    pairs = "|".join(f"(?<={re.escape(left)}){any_of(right)}" for left, right in sorted(border.items(), reverse=True))
    both = f"(?<={any_of(border)})(?={any_of(c for right in border.values() for c in right)})"  # most borders end here
    return re.compile(f"{RUN}(?:{both}(?={pairs}){RUN})*+")


class Known(dict[str, str]):
    """What ``find`` says of units: of the last ``CACHED_UNITS`` new ones, and as many before these."""

    def __init__(self, find: Callable[[str], str]):
        self.find = find
        self.old: dict[str, str] = {}

    def __missing__(self, unit: str) -> str:
        found = self.old.get(unit)
        if found is None:
            found = self.find(unit)
        if len(unit) <= CACHED_CHARS:
            if len(self) >= CACHED_UNITS:
                self.old = dict(self)
                self.clear()
            self[unit] = found
        return found


class PieceCodec:
    """Encoder and decoder of one vocabulary of the merge type with byte fallback.

    ``model`` is the content of a vocabulary file. The library is used to read it, not to encode. The
    vocabulary must not normalise, and must add a space before the text: checked when it is read.
    """

    def __init__(self, model: bytes):
        vocabulary = SentencePieceProcessor(model_proto=model)
        probe = " ﬁ  Å\t "
        if vocabulary.normalize(probe) != (SPACE + probe.replace(" ", SPACE)):
            raise ValueError("vocabularies with a normaliser are not supported")
        self.pieces = [vocabulary.id_to_piece(i) for i in range(vocabulary.get_piece_size())]
        special = [vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_unused(i) for i in range(len(self.pieces))]
        self.bytes = {i: int(p[3:5], 16) for i, p in enumerate(self.pieces) if vocabulary.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        if len(self.byte_ids) != 256:
            raise ValueError("a vocabulary with all 256 byte pieces is needed")
        self.silent = {i for i, s in enumerate(special) if s}
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and i not in self.bytes}
        by_score = sorted({vocabulary.get_score(i) for i in self.ids.values()}, reverse=True)
        order = {score: rank for rank, score in enumerate(by_score)}
        self.ranks = {p: order[vocabulary.get_score(i)] for p, i in self.ids.items() if len(p) > 1}
        self.halves: dict[str, tuple[str, str]] = {}  # the two parts of a piece's last merge
        reached = {p for p in self.ids if self.merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for piece in reached:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.width = max(map(len, reached))
        self.shorter = {p: self.prefix(p, reached) for p in reached if len(p) > 1}
        self.units_of = units_pattern({piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)})
        self.names = {p: str(i) for p, i in self.ids.items()}
        self.named = {name: p for p, name in self.names.items()}
        self._compatible: dict[tuple[str, str], bool] = {}
        self._known = Known(self.unit_names)
        self._odd: dict[str, str] = {}  # units that their ids do not spell

    def prefix(self, piece: str, pieces: set[str]) -> str:
        """The longest shorter piece that ``piece`` begins with, at least its first character."""
        return next(piece[:n] for n in range(len(piece) - 1, 0, -1) if n == 1 or piece[:n] in pieces)

    def merged(self, text: str) -> list[str]:
        """Pieces by merging, best first and leftmost among equals: the definition, for short texts."""
        ranks, parts = self.ranks, list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts
            if len(parts) == 2:
                self.halves[parts[0] + parts[1]] = parts[0], parts[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Does merging ``left + right`` give these two pieces?

        The merges that made the two are replayed backwards, latest first. They are not compatible if at
        some point a merge across the border comes before the merge just undone.
        """
        found = self._compatible.get((left, right))
        if found is None:
            if len(self._compatible) >= CACHED_PAIRS:
                self._compatible.clear()
            found = self._compatible[left, right] = self._replay(left, right)
        return found

    def _replay(self, left: str, right: str) -> bool:
        ranks, halves = self.ranks, self.halves
        left_rank, right_rank = ranks.get(left, -1), ranks.get(right, -1)
        limit = (len(ranks), 0)  # rank, and 1 if the undone merge lies right of the border
        while True:
            across = ranks.get(left + right)
            if across is not None and (across < limit[0] or across == limit[0] and limit[1]):
                return False
            single = len(left) == 1, len(right) == 1
            if all(single):
                return True
            if not single[0] and (single[1] or left_rank > right_rank):
                limit = left_rank, 0
                left = halves[left][1]
                left_rank = ranks.get(left, -1)
            else:
                limit = right_rank, 1
                right = halves[right][0]
                right_rank = ranks.get(right, -1)

    def longest(self, unit: str, place: int) -> str:
        """The longest piece at ``place``, or one character that is no piece."""
        ahead = unit[place : place + self.width]  # the automaton copies what it is given
        for end, length in self.automaton.iter_long(ahead):
            if end + 1 == length:
                return ahead[:length]
            break
        return ahead[0]

    def split(self, unit: str) -> list[str]:
        """Pieces of one unit by backtracking."""
        compatible = self._compatible
        size = len(unit)
        failed = bytearray(size // 8 + 1)
        chosen: list[str] = []
        place, last = 0, ""
        for end, length in self.automaton.iter_long(unit):  # one pass gives the longest pieces, as far as they are compatible
            if end - length + 1 != place:
                break
            piece = unit[place : end + 1]
            if last:
                fits = compatible.get((last, piece))
                if not (self.compatible(last, piece) if fits is None else fits):
                    break
            chosen.append(piece)
            last, place = piece, end + 1
        if place == size:
            return chosen
        piece = self.longest(unit, place)
        while True:
            while piece:
                end = place + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if not chosen:
                        break
                    fits = compatible.get((chosen[-1], piece))
                    if self.compatible(chosen[-1], piece) if fits is None else fits:
                        break
                piece = self.shorter.get(piece, "")
            if piece:
                chosen.append(piece)
                place = end
                if place == size:
                    return chosen
                piece = self.longest(unit, place)
            else:
                failed[place >> 3] |= 1 << (place & 7)
                piece = chosen.pop()
                place -= len(piece)
                piece = self.shorter.get(piece, "")

    def unit_ids(self, unit: str) -> list[int]:
        ids: list[int] = []
        for piece in [unit] if len(unit) == 1 else self.split(unit):
            if piece in self.ids:
                ids.append(self.ids[piece])
            else:
                ids.extend(self.byte_ids[b] for b in piece.encode())
        return ids

    def unit_names(self, unit: str) -> str:
        """Comma-joined ids of a unit. What they spell is compared with the unit, and noted if it differs."""
        try:
            names = [self.names[piece] for piece in ([unit] if len(unit) == 1 else self.split(unit))]
            spelled = "".join([self.named[name] for name in names])
        except KeyError:  # characters that are no pieces
            ids = self.unit_ids(unit)
            names, spelled = map(str, ids), self.spelled(ids).replace(" ", SPACE)
        if spelled != unit:
            self._odd[unit] = spelled
        return ",".join(names)

    def units(self, text: str) -> list[str]:
        """``text`` with its leading space, cut after words and marks, where the two characters stand side by side in no piece."""
        return self.units_of.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units(text) for i in self.unit_ids(unit)]

    def spelled(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            if i in self.bytes:
                run.append(self.bytes[i])
                continue
            if run:
                out.append(decoded_bytes(bytes(run)))
                run.clear()
            if i not in self.silent:
                out.append(self.pieces[i].replace(SPACE, " "))
        out.append(decoded_bytes(bytes(run)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text, without the space that encoding put before it."""
        spelled = self.spelled(ids)
        first = next((self.pieces[i] for i in ids if i not in self.silent), "")
        return spelled[1:] if first.startswith(SPACE) else spelled

    def round_trip(self, text: str) -> tuple[str, str]:
        """Comma-joined ids of ``text``, and the text decoded from them.

        Byte pieces of one character lie in one unit, so that units may be spelled apart.
        """
        units = self.units(text)
        ids = ",".join(map(self._known.__getitem__, units))
        spelled = "".join([self._odd.get(unit, unit) for unit in units] if self._odd else units)
        return ids, spelled.replace(SPACE, " ").removeprefix(" ")


def decoded_bytes(run: bytes) -> str:
    """UTF-8, with one replacement character for each byte that is part of no character."""
    try:
        return run.decode()
    except UnicodeDecodeError as error:
        good = run[: error.start].decode()
        return good + REPLACEMENT + decoded_bytes(run[error.start + 1 :])


@lru_cache(maxsize=2)
def codec(model: bytes) -> PieceCodec:
    """One codec for each worker process."""
    return PieceCodec(model)


def encode_documents(docs: DataFrame, model: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, ids, decoded`` of every row: comma-joined piece ids and the text decoded from them. No shuffle.

    A null text counts as empty: no ids, empty text. Repeated rows, null ids and other columns are of no
    consequence: one output row for each input row. ``model`` (a file's content) is sent with the tasks.
    """
    kind = docs.schema[id].dataType
    schema = StructType().add(id, kind).add("ids", "string").add("decoded", "string")

    def work(batches: Rows) -> Rows:
        pieces = codec(model)
        for batch in batches:
            both = [pieces.round_trip(t or "") for t in batch["_text"]]
            yield {id: batch[id], "ids": [b[0] for b in both], "decoded": [b[1] for b in both]}

    return map_batches(docs.select(id, docs[text].alias("_text")), work, schema)


def encoding_digests(docs: DataFrame, model: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of every row; see ``encode_documents``.

    The digests are taken in the same tasks, so that ids and texts need not leave them.
    """
    kind = docs.schema[id].dataType
    schema = (
        StructType().add(id, kind).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    )

    def work(batches: Rows) -> Rows:
        pieces = codec(model)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in schema.names} | {id: batch[id]}
            for t in batch["_text"]:
                ids, decoded = pieces.round_trip(t or "")
                out["n_tokens"].append(ids.count(",") + 1 if ids else 0)
                out["ids_sha256"].append(hexdigest(ids.encode()))
                out["decoded_sha256"].append(hexdigest(decoded.encode()))
            yield out

    return map_batches(docs.select(id, docs[text].alias("_text")), work, schema)
