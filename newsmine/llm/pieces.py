"""SentencePiece (merge type) encoding by a prefix table, and decoding.

Every prefix of a text has one last token in its own encoding. An automaton
gives the pieces that end at a place; of these the last token is the one that
can stand behind the last token of what is left, which a test of the pair alone
decides. The ids of the whole text are then read off backwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from newsmine.llm.common import narrow, original, per_batch

BLANK = "▁"  # stands for a blank inside pieces
_MEMORY = 400_000  # remembered stretches and pairs, each in two generations


class Memo(dict):
    """A bounded memory: when full, the older half is forgotten."""

    def __init__(self, size: int = _MEMORY) -> None:
        super().__init__()
        self.size, self.old = size, {}

    def find(self, key):
        value = self.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self[key] = value
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


class Codec:
    """The vocabulary of one model file and its two directions."""

    def __init__(self, path: str) -> None:
        model = SentencePieceProcessor(model_file=path)
        self.unknown = model.unk_id()
        self.score: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        self.surface: list[str] = []
        self.automaton = ahocorasick.Automaton()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[i] = int(piece[3:5], 16)
                self.surface.append("")
            elif model.is_control(i) or model.is_unknown(i):
                self.surface.append(" ⁇ " if model.is_unknown(i) else "")
            else:
                self.surface.append(piece.replace(BLANK, " "))
                self.number[piece], self.score[piece] = i, model.get_score(i)
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.piece = {i: p for p, i in self.number.items()}
        self.bytes = {b: i for i, b in self.byte.items()}
        # No piece holds a blank behind another character, so a blank after one begins a new stretch.
        split = not any(BLANK in p.lstrip(BLANK) for p in self.number)
        self.stretch = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+" if split else r"(?s).+")
        self.pairs, self.stretches = Memo(), Memo()

    def _merged(self, text: str) -> list[str]:
        """Best pair first, the leftmost of equals: used on single pieces and pairs of pieces only."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _may_follow(self, before: int, token: int) -> bool:
        """Whether the two pieces side by side stay as they are; -1 stands for the start, -2 for an unknown character."""
        key = (before, token)
        found = self.pairs.find(key)
        if found is None:
            own = self.piece[token]
            found = self._merged(self.piece[before] + own) == [self.piece[before], own] if before >= 0 else self._merged(own) == [own]
            self.pairs.put(key, found)
        return found

    def encode_stretch(self, text: str) -> list[int]:
        ending: list[list[tuple[int, int]]] = [[] for _ in text]
        for end, match in self.automaton.iter(text):
            ending[end].append(match)
        last: list[int] = []
        for end, matches in enumerate(ending):
            chosen = -2
            for size, token in matches:
                before = last[end - size] if size <= end else -1
                if self._may_follow(before, token):
                    chosen = token
                    break
            last.append(chosen)
        ids: list[int] = []
        end = len(text) - 1
        while end >= 0:  # backwards
            token = last[end]
            if token >= 0:
                ids.append(token)
                end -= len(self.piece[token])
            else:
                raw = text[end].encode("utf-8")
                ids.extend(self.bytes.get(b, self.unknown) for b in reversed(raw)) if self.bytes else ids.append(self.unknown)
                end -= 1
        return ids[::-1]

    def spans(self, text: str) -> Iterator[str]:
        """The marked text in stretches that no piece crosses."""
        return self.stretch.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for part in self.spans(text) for i in self.encode_stretch(part)]

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``: the first blank goes, byte pieces are joined to characters."""
        out: list[str] = []
        run = bytearray()
        first = True
        for i in ids:
            if i in self.byte:
                run.append(self.byte[i])
                continue
            if run:
                out.append(characters(bytes(run)))
                run.clear()
            own = self.surface[i]
            out.append(own[1:] if first and own[:1] == " " and i != self.unknown and not any(out) else own)
            first = first and not own
        return "".join([*out, characters(bytes(run))])


def characters(run: bytes) -> str:
    """UTF-8 text; every byte that belongs to no character becomes U+FFFD."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + size].decode("utf-8"))
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row; a null text counts as empty and has no ids."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for at in range(0, batch.num_rows, 64):
            rows = batch.slice(at, 64)
            ids = [own.encode(t.as_py() or "") for t in rows.column(1)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    found = narrow(docs).mapInArrow(per_batch(work), "id long, ids array<int>")
    return found.select(original(F.col("id")).alias("doc_id"), "ids")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids give an empty text."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        texts = [own.decode(i or []) for i in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(per_batch(work), "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, ids and text in one pass.

    Stretches seen before are remembered with their ids and text in a bounded
    memory per worker. Null and empty texts have no ids and decode to an empty
    text. Repeated rows are encoded one by one; other columns are not read. An
    empty table gives an empty result.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        memo = own.stretches
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            sizes, names, texts = [], [], []
            for value in rows.column(1):
                total, written, read = 0, [], []
                for part in own.spans(value.as_py() or ""):
                    known = memo.find(part)
                    if known is None:
                        ids = own.encode_stretch(part)
                        # A blank in front keeps the stretch's own one from being taken as the text's first.
                        known = len(ids), ",".join(map(str, ids)), own.decode([own.number[BLANK], *ids])
                        if len(part) < 64:
                            memo.put(part, known)
                    total += known[0]
                    written.append(known[1])
                    read.append(known[2])
                sizes.append(total)
                names.append(hashlib.sha256(",".join(written).encode()).hexdigest())
                texts.append(hashlib.sha256("".join(read)[1:].encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes, pa.int64()), pa.array(names), pa.array(texts)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    found = narrow(docs).mapInArrow(per_batch(work), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.select(original(F.col("id")).alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
