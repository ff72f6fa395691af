"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A score-ordered agenda of adjacent symbol pairs merges each run of characters;
runs are the parts of a text between places that no piece of the vocabulary can
span, so merges never cross from one to the next and a run's result can be kept.
Words that a batch meets for the first time go through their agendas in step:
each round merges every word's best pair. Every newly met word or run is
checked, batch by batch, against the sentencepiece library, in both directions.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import extended, map_batches, table

SPACE = "▁"
KEPT = 80_000
TEXTS_AT_ONCE = 384
LONGEST_KEPT = 48
SHORT = 40
#: Words learnt at once, words whose agendas run in step, and words in a text that the library checks.
WORDS_AT_ONCE, ROWS_AT_ONCE, WORDS_CHECKED = 8192, 4096, 16


class Codec:
    """Encoder and decoder for one model file of type BPE with byte fallback and the identity normaliser."""

    def __init__(self, model_path: str, check: bool = True):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.check = check
        size = sp.get_piece_size()
        if any(sp.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not supported")
        if sp.normalize("ﬁ A  é ") != f"{SPACE}ﬁ{SPACE}A{SPACE}{SPACE}é{SPACE}":
            raise ValueError("only models with the identity normaliser and a dummy prefix are supported")
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ids = {self.pieces[i]: i for i in normal}
        scores = sorted({sp.get_score(i) for i in normal}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        self.rank = {self.pieces[i]: place[sp.get_score(i)] for i in normal if len(self.pieces[i]) > 1}
        self.none = len(scores)
        self.bytes = [0] * 256
        for i in range(size):
            if sp.is_byte(i):
                self.bytes[int(self.pieces[i][1:-1], 16)] = i
        if not all(self.bytes):
            raise ValueError("only models with byte fallback are supported")
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.silent = {i for i in range(size) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("a piece holds a space after another character")
        # A character that is part of no longer piece never merges, so it ends a run.
        joined = sorted({c for p in self.rank for c in p} - {SPACE})
        # Where no piece has a letter before another kind of character, a run ends between them too.
        mixed = any(a.isalpha() and not b.isalpha() for p in self.rank for a, b in zip(p, p[1:]))
        letters = "".join(re.escape(c) for c in joined if c.isalpha())
        other = "".join(re.escape(c) for c in joined if not c.isalpha())
        inner = f"[{letters}{other}]+" if mixed else f"(?:[{other}]*[{letters}]+|[{other}]+)"
        self.runs = re.compile(f"{SPACE}*{inner}|{SPACE}+|(?s:.)").findall if letters and other else list
        self.spelling = [None if i in self.byte_of or i in self.silent or i == self.unknown else self.pieces[i].replace(SPACE, " ") for i in range(size)]
        self.kept_runs, self.kept_words = Kept(), Kept()
        self.agendas = Agendas(self)

    def merge(self, run: str) -> list[str]:
        """The agenda: always merge the best-scored adjacent pair, the leftmost among equals."""
        rank, n = self.rank, len(run)
        if n <= SHORT:
            return self._merge_short(list(run))
        symbols: list[str | None] = list(run)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        shift = n.bit_length()
        mask = (1 << shift) - 1
        agenda = [rank[m] << shift | i for i, m in enumerate(map(add, run, run[1:])) if m in rank]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & mask
            j = after[i]
            if j == n or symbols[i] is None:
                continue
            merged = symbols[i] + symbols[j]
            if rank.get(merged) != entry >> shift:  # outdated
                continue
            symbols[i], symbols[j] = merged, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := merged + symbols[k]) in rank:
                    heappush(agenda, rank[m] << shift | i)
            if (h := before[i]) >= 0 and (m := symbols[h] + merged) in rank:
                heappush(agenda, rank[m] << shift | h)
        return [s for s in symbols if s is not None]

    def _merge_short(self, symbols: list[str]) -> list[str]:
        """The agenda of a short run is a plain list of the pairs' ranks, cheaper than a heap."""
        ranked, none = self.rank.get, self.none
        agenda = [ranked(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda and (best := min(agenda)) != none:
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = ranked(symbols[i] + symbols[i + 1], none)
            if i:
                agenda[i - 1] = ranked(symbols[i - 1] + symbols[i], none)
        return symbols

    def encode_run(self, run: str) -> list[int]:
        ids = self.ids
        if run in ids and len(run) == 1:
            return [ids[run]]
        out: list[int] = []
        for piece in self.merge(run):
            found = ids.get(piece)
            if found is None:
                out += [self.bytes[b] for b in piece.encode()]
            else:
                out.append(found)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of ids; the dummy prefix is dropped."""
        return self._spell(ids, True)

    def _spell(self, ids: list[int], first: bool) -> str:
        spelled = [self.spelling[i] for i in ids]
        if not first and None not in spelled:
            return "".join(spelled)
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                first = False
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i in self.silent:
                continue
            piece = " ⁇ " if i == self.unknown else self.pieces[i].replace(SPACE, " ")
            if first and piece.startswith(" ") and i != self.unknown:
                piece = piece[1:]
            first = False
            out.append(piece)
        if held:
            out.append(_utf8(bytes(held)))
        return "".join(out)

    def split(self, text: str) -> list[str]:
        return self.runs(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, runs: list[str]) -> dict[str, tuple[bytes, str]]:
        """Encode runs that are not kept and check them against the library."""
        found = {r: (ids := self.encode_run(r), self._spell(ids, False)) for r in runs}
        if self.check:
            # The library starts a text with a space: a run that has one of its own gives it up, any other follows a newline-like anchor.
            plain = [r for r in runs if r.startswith(SPACE)]
            for r, ids in zip(plain, self.library.encode([r[1:].replace(SPACE, " ") for r in plain], num_threads=1)):
                if ids != found[r][0] and r != SPACE:
                    raise AssertionError(f"the library encodes {r[:80]!r} otherwise")
            other = [r for r in runs if not r.startswith(SPACE)]
            for r, ids in zip(other, self.library.encode(["\x01" + r for r in other], num_threads=1)):
                if ids[2:] != found[r][0]:
                    raise AssertionError(f"the library encodes {r[:80]!r} otherwise")
            mark = [self.bytes[1]]
            for r, text in zip(runs, self.library.decode([mark + found[r][0] for r in runs])):
                if text != "\x01" + found[r][1]:
                    raise AssertionError(f"the library decodes {r[:80]!r} otherwise")
        return {r: (_packed(ids), text) for r, (ids, text) in found.items()}

    def learn_words(self, words: list[str]) -> dict[str, bytes | tuple[bytes, str]]:
        """Encode words that start with a space and are not kept; check them against the library.

        Of a word whose ids decode to itself the ids alone are returned; of any
        other, such as one with bytes that are no character, its spelling too.
        """
        known, lengths, symbols = self.agendas.symbols(words)
        fit = [w for w, k in zip(words, known) if k]
        rest = [w for w, k in zip(words, known) if not k]
        found: dict = {}
        for w, (raw, spelled) in zip(rest, self.encode_runs([self.runs(SPACE + w) for w in rest]) if rest else ()):
            found[w] = raw if spelled == " " + w else (raw, spelled)
        for start in range(0, len(fit), WORDS_AT_ONCE):
            part = fit[start : start + WORDS_AT_ONCE]
            flat, counts = self.agendas.merge(part, lengths[start : start + WORDS_AT_ONCE], symbols)
            listed = flat.tolist()
            text = "".join(map(self.spelling.__getitem__, listed))
            if self.check:
                ids = self.library.encode([" ".join(part[k : k + WORDS_CHECKED]) for k in range(0, len(part), WORDS_CHECKED)], num_threads=1)
                if list(chain.from_iterable(ids)) != listed:
                    raise AssertionError("the library encodes one of these words otherwise: " + " ".join(part)[:2000])
                if "".join([" " + x for x in self.library.decode(ids)]) != text:
                    raise AssertionError("the library decodes one of these words otherwise: " + " ".join(part)[:2000])
            raw = flat.astype("<i4").tobytes()
            if text != " " + " ".join(part):
                raise AssertionError("pieces of single characters spell one of these words otherwise: " + " ".join(part)[:2000])
            ends = (4 * np.cumsum(counts)).tolist()
            found.update(zip(part, [raw[a:b] for a, b in zip([0, *ends], ends)]))
        return found

    def encode_runs(self, texts: list[list[str]]) -> list[tuple[bytes, str]]:
        """Each list of runs as one sequence of ids and its spelling, the dummy prefix included."""
        wanted = {r for runs in texts for r in runs}
        found = self.kept_runs.ready(wanted, self.learn)
        out = [(b"".join([found[r][0] for r in runs]), "".join([found[r][1] for r in runs])) for runs in texts]
        self.kept_runs.forget(wanted)
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids and decoded text of each whole text.

        A text in which spaces stand alone is a sequence of words that each start
        with one; words are kept like runs. Other texts are cut into runs at once.
        """
        for first in range(0, len(texts), TEXTS_AT_ONCE):
            yield from self._encode_part(texts[first : first + TEXTS_AT_ONCE])

    def _encode_part(self, part: list[str]) -> list[tuple[np.ndarray, str]]:
        # The many small objects made here hold no cycles; so looking for cycles among the kept ones is idle work.
        collecting = gc.isenabled()
        gc.disable()
        try:
            words = [t.split(" ") if t and "  " not in t and SPACE not in t and t[0] != " " and t[-1] != " " else None for t in part]
            wanted: set[str] = set()
            for own in words:
                if own:
                    wanted.update(own)
            found = self.kept_words.ready(wanted, self.learn_words)
            out = []
            for text, own in zip(part, words):
                if own:
                    got = [found[w] for w in own]
                    try:
                        raw, decoded = b"".join(got), text  # every word decodes to itself
                    except TypeError:
                        both = [g if isinstance(g, tuple) else (g, " " + w) for g, w in zip(got, own)]
                        raw, decoded = b"".join([g[0] for g in both]), "".join([g[1] for g in both])[1:]
                else:
                    ((raw, decoded),) = self.encode_runs([self.split(text)])
                    decoded = decoded[1:] if decoded.startswith(" ") else decoded
                out.append((np.frombuffer(raw, "<i4"), decoded))
            self.kept_words.forget(wanted)
            return out
        finally:
            if collecting:
                gc.enable()


class Agendas:
    """The agendas of many words at once, one row of symbols for each word.

    ``table`` maps a pair of ids to the rank and the id of what they merge to, by
    open addressing. A row's best pair is the first of least rank, so all words
    take the same steps as one by one.
    """

    def __init__(self, codec: Codec):
        ids, rank = codec.ids, codec.rank
        self.none = codec.none
        self.single = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = i
        # A character that no piece is, but that a longer one holds, would merge without an id of its own.
        self.start = int(self.single[ord(SPACE)])
        pairs = [(ids[p[:k]], ids[p[k:]], r, ids[p]) for p, r in rank.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        a, b, ranks, merged = (np.array(x, dtype=np.int64) for x in zip(*pairs))
        self.bits = max(4, int(2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, self.none, dtype=np.int32)
        self.merged = np.zeros(1 << self.bits, dtype=np.int32)
        key, at = a << 32 | b, self._place(a, b)
        left = np.arange(len(key))
        while len(left):
            free = left[self.keys[at[left]] == -1]
            self.keys[at[free]] = key[free]  # of several at one place the last stays
            stays = self.keys[at[left]] == key[left]
            done = left[stays]
            self.ranks[at[done]], self.merged[at[done]] = ranks[done], merged[done]
            left = left[~stays]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _place(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = (a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of each merged pair; ids below zero merge with nothing."""
        key, at = a.astype(np.int64) << 32 | b.astype(np.int64), self._place(a, b)
        seen = self.keys[at]
        while len(off := np.flatnonzero((seen != key) & (seen != -1))):
            at[off] = (at[off] + 1) & ((1 << self.bits) - 1)
            seen[off] = self.keys[at[off]]
        return np.where(seen == key, self.ranks[at], self.none), self.merged[at]

    def symbols(self, words: list[str]) -> tuple[list[bool], np.ndarray, np.ndarray]:
        """Which words are short and of single-character pieces only; the lengths of those and all their symbols, padded with -1."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        at = np.repeat(np.arange(len(words)), lengths)
        codes = self.single[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")]
        known = lengths <= SHORT
        known[at[codes < 0]] = False
        keep = known[at]
        lengths = lengths[known]
        symbols = np.full((len(lengths), int(lengths.max(initial=0)) + 1), -1, dtype=np.int32)
        symbols[:, 0] = self.start
        rows = np.repeat(np.arange(len(lengths)), lengths)
        symbols[rows, np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1] = codes[keep]
        self._at = 0
        return known.tolist(), lengths, symbols

    def merge(self, words: list[str], lengths: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the next ``words`` after all merges, one after another, and the number of each word's."""
        first, self._at = self._at, self._at + len(words)
        # Words of like length share a block, so that rows have little padding.
        order = np.argsort(lengths, kind="stable")
        counts = np.zeros(len(words), dtype=np.int64)
        blocks = []
        for k in range(0, len(words), ROWS_AT_ONCE):
            rows = order[k : k + ROWS_AT_ONCE]
            block = self._merge_rows(symbols[first + rows, : int(lengths[rows].max()) + 1])
            counts[rows] = (block >= 0).sum(axis=1)
            blocks.append((rows, block))
        flat = np.empty(int(counts.sum()), dtype=np.int32)
        starts = np.cumsum(counts) - counts
        for rows, block in blocks:
            held = block >= 0
            n = counts[rows]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            flat[np.repeat(starts[rows], n) + within] = block[held]
        return flat, counts

    def _merge_rows(self, rows: np.ndarray) -> np.ndarray:
        """Rows of symbols, filled up with -1, after all their merges.

        Symbols, ranks and merged ids are held place by place (one line for each
        place in the words), so every step is a few passes over short lines.
        """
        out = np.full_like(rows, -1)
        name = np.arange(len(rows))
        symbols = np.ascontiguousarray(rows.T)
        width, none = len(symbols), self.none
        pairs = [self.look_up(symbols[k], symbols[k + 1]) for k in range(width - 1)]
        ranks, merged = np.array([r for r, _ in pairs]), np.array([m for _, m in pairs])
        while True:
            best, least = np.zeros(len(name), dtype=np.int32), ranks[0]
            for k in range(1, width - 1):  # the first of the least: a later place must be lower
                lower = ranks[k] < least
                best = np.where(lower, np.int32(k), best)
                least = np.where(lower, ranks[k], least)
            going = least != none
            left = int(np.count_nonzero(going))
            if 4 * left < 3 * len(name):
                out[name[~going], :width] = symbols[:, ~going].T
                if not left:
                    return out
                name, best = name[going], best[going]
                symbols, ranks, merged = symbols[:, going], ranks[:, going], merged[:, going]
                going = np.ones(left, dtype=bool)
            if not left:
                out[name, :width] = symbols.T
                return out
            at = np.flatnonzero(going)
            place = best[at]
            symbols[place, at] = merged[place, at]
            # What follows the pair moves up by one, in the words that go on.
            best = np.where(going, best, np.int32(width))
            for k in range(1, width - 1):
                behind = best < k
                symbols[k] = np.where(behind, symbols[k + 1], symbols[k])
                if k < width - 2:
                    ranks[k] = np.where(behind, ranks[k + 1], ranks[k])
                    merged[k] = np.where(behind, merged[k + 1], merged[k])
            symbols[width - 1, at] = -1
            ranks[width - 2, at] = none
            for side in (place - 1, place):  # the pairs on both sides of the new symbol
                there = np.flatnonzero((side >= 0) & (side < width - 1))
                to, column = side[there], at[there]
                ranks[to, column], merged[to, column] = self.look_up(symbols[to, column], symbols[to + 1, column])


class Kept:
    """A bounded store in two generations: what is not met again while the younger one fills is dropped."""

    def __init__(self, size: int = KEPT):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def ready(self, keys: set[str], learn) -> dict:
        """The younger generation with all of ``keys`` in it; what is in neither is learnt. It serves until the next call."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        wanted = keys - young.keys()
        again = wanted & old.keys()
        young.update(zip(again, map(old.__getitem__, again)))
        if missing := list(wanted - again):
            young.update(learn(missing))
        return young

    def forget(self, keys: set[str]) -> None:
        """Drop the long ones of ``keys``, which would fill the store."""
        for k in keys:
            if len(k) > LONGEST_KEPT:
                self.young.pop(k, None)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<i4").tobytes()


def _utf8(raw: bytes) -> str:
    """Bytes as text; each byte that is not part of a character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i : i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


_codecs: dict[tuple[str, bool], Codec] = {}


def codec(model_path: str, check: bool = True) -> Codec:
    """One codec for each worker process and model, so that kept runs serve the next task."""
    key = (model_path, check)
    if key not in _codecs:
        _codecs[key] = Codec(model_path, check)
    return _codecs[key]


def forget() -> None:
    """Drop what the codecs of this worker process have kept."""
    for held in _codecs.values():
        held.kept_runs, held.kept_words = Kept(), Kept()


def encode_texts(texts: list[str | None], model_path: str, check: bool = True) -> Iterator[tuple[np.ndarray, str]]:
    return codec(model_path, check).encode_batch([t or "" for t in texts])


def encode_decode(df: DataFrame, model_path: str, text_column: str = "text", check: bool = True) -> DataFrame:
    """Add ``piece_ids`` (array of int) and ``piece_text`` (the ids decoded again) to every row.

    A null or empty text gives no ids and an empty text. Texts are encoded whole,
    however long and however long their words; equal texts give equal ids, and
    of pairs with the same score the leftmost merges first, as in the library.
    Repeated rows stay repeated. Columns with these names are replaced, all
    others stay.
    """
    df = df.drop("piece_ids", "piece_text")
    schema = extended(df.schema, piece_ids=T.ArrayType(T.IntegerType()), piece_text=T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(start, TEXTS_AT_ONCE)
                found = list(encode_texts(batch[text_column].to_pylist(), model_path, check))
                ids = pa.array([i for i, _ in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array([t for _, t in found], pa.string())], [*batch.schema.names, "piece_ids", "piece_text"])

    return map_batches(df, run, schema, keeps=__name__)


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(df: DataFrame, model_path: str, check: bool = True) -> DataFrame:
    """``doc_id`` and the digests of ids and decoded text, taken from the operator's batches where they are made.

    One row for each input row, whatever its doc_id (null and repeated ones too);
    a null text counts as empty: no ids, and the digests of empty strings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = list(map(str, range(len(codec(model_path, check).pieces))))
        for batch in batches:
            counts, by_ids, by_text = [], [], []
            for ids, text in encode_texts(batch["text"].to_pylist(), model_path, check):
                counts.append(len(ids))
                by_ids.append(hashlib.sha256(",".join(map(spelled.__getitem__, ids.tolist())).encode()).hexdigest())
                by_text.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    id_type = df.schema["doc_id"].dataType.simpleString()
    return map_batches(df.select("doc_id", "text"), run, f"doc_id {id_type}, {DIGESTS}", keeps=__name__)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents encoded and decoded; digests of both."""
    return token_digests(table(spark, sf_dir, "documents"), model_path())


QUERIES = {"op2_sentencepiece": op2_sentencepiece}
ORACLE_SQL: dict[str, str] = {}
