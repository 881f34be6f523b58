"""Token counts by a compiled finite-state transducer (operator 10).

A byte-pair tokenizer with word ends is compiled into a deterministic transducer over characters
whose transitions carry emitted-token counts. A state knows what the pending word's
merges depend on: for each place where a token could still begin, the last token of the
merge result up to there, and its count relative to now. Which token follows is decided by
pairwise compatibility: a sequence of tokens is the merge result exactly if
each neighbouring pair is the merge result of its own characters. States are
found as texts need them, like a lazy automaton, into dense tables for the commonest characters and a sparse one
for all others. Tables of a bounded size are begun anew, also within a text: whatever outlasts a
step is held as the state itself, not as its number.

Texts are cut into chunks that run in lock step, a vector of states at a time. A chunk's
state map is composed from what precedes its first word boundary, which depends on the state
it is entered with, and the rest, which does not: (head, exit state, count). Maps compose
associatively, so a text's chunks are reduced as in a parallel prefix scan.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded

LIMIT = 2048
#: Characters of a chunk, lanes that run at once, and states, and transitions of rarer characters, after which tables are begun anew.
CHUNK, LANES, MOST_STATES, MOST_RARE = 2048, 2048, 200_000, 400_000
#: Rows by which tables grow, their columns (one for each of the commonest characters), and texts' characters counted together.
ROWS, COLUMNS, TOGETHER = 16_384, 128, 1 << 22
#: Characters that have a column: ASCII as normalised, and Latin letters with marks; others get the columns left as they come.
COMMON = [*range(0x20, 0x41), *range(0x5B, 0x7F), 0x0A, 0x09, *range(0xDF, 0x100)]

#: Last tokens are kept as sets of fitting tokens where at most so many tokens may begin.
FEW = 6
NONE = ("", 0)

OTHER, LETTER, NUMBER, GAP = 0, 1, 2, 3
#: Endings that the tokenizer's pattern splits off after an apostrophe that begins a word.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


class Transducer:
    """The compiled tokenizer file; counts tokens of normalised texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.end: str = spec["model"]["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        added = set(self.special)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.of_byte = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in printable)}
        self.tokens = {t for t in self.vocab if t not in added}
        self.prefixes = {t[:i] for t in self.tokens if not t.endswith(self.end) for i in range(1, len(t) + 1)}
        self.prefixes |= {t[: -len(self.end)][:i] for t in self.tokens if t.endswith(self.end) for i in range(1, len(t) - len(self.end) + 1)}
        self.beginning: dict[str, list[str]] = {}
        for t in self.tokens:
            body = t.removesuffix(self.end) if t != self.end else t
            for i in range(1, len(body) + 1):
                self.beginning.setdefault(body[:i], []).append(t)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.reset()

    # --- words ---

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merge(self, parts: list[str]) -> list[str]:
        """The merge result of symbols: always the pair of least rank, leftmost first."""
        while len(parts) > 1:
            rank, i = min((self.ranks.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 30:
                break
            parts = [*parts[:i], parts[i] + parts[i + 1], *parts[i + 2 :]]
        return parts

    def fits(self, a: str | None, b: str) -> bool:
        """Whether token b may follow token a (None: the word begins)."""
        if isinstance(a, frozenset):
            return b in a
        if a is None:
            return self.merge(self._symbols(b)) == [b]
        key = (a, b)
        found = self.pairs.get(key)
        if found is None:
            found = self.pairs[key] = self.merge(self._symbols(a) + self._symbols(b)) == [a, b]
        return found

    # --- states: what a pending word's future depends on ---
    # A word state is (suffix, last): the longest suffix of the word that begins some token, and for each place
    # 0..len(suffix) characters back the last token before it (None at the word's beginning, "" where no
    # token can end) with its count relative to now.

    START = ("", ((None, 0),))

    def _follow(self, state: tuple, symbol: str, final: bool) -> tuple[str, int]:
        """Last token and relative count after a symbol, which ends the word if final."""
        suffix, last = state
        whole = suffix + symbol
        for back in range(len(suffix), -1, -1):
            token = whole[len(whole) - back - 1 :] + (self.end if final else "")
            if back < len(last) and token in self.tokens and last[back][0] != "" and self.fits(last[back][0], token):
                return token, last[back][1] + 1
        return "", 0

    def step(self, state: tuple, symbol: str) -> tuple[tuple, int]:
        """Next word state after an inner symbol, and by how much its count grows."""
        suffix, last = state
        token, count = self._follow(state, symbol, False)
        grown = suffix + symbol
        history = ((token, 0), *((t, c - count) for t, c in last))
        while grown and grown not in self.prefixes:
            grown = grown[1:]
        return (grown, history[: len(grown) + 1]), count

    def settle(self, state: tuple, pending: str) -> tuple:
        """The state without what can't matter once pending follows: places where no token can begin any more.

        More words share a state so. A last token is kept as which of the tokens that
        may yet begin there fit it, where they are few.
        """
        suffix, last = state
        n = len(suffix)
        kept = max((k for k in range(n + 1) if suffix[n - k :] + pending in self.prefixes), default=0)
        share = self.shared.setdefault
        out = []
        for k in range(kept + 1):
            head = suffix[n - k :] + pending
            token, count = last[k]
            if token != "" and head in self.prefixes:
                fitting = self.fitting(token, head)
                entry = (fitting, count) if fitting != frozenset() else NONE
            else:
                entry = NONE
            out.append(share(entry, entry))
        suffix = suffix[n - kept :]
        return share(suffix, suffix), tuple(out)

    def fitting(self, token, head: str):
        """The tokens beginning with head that may follow token, if head has few; else token itself."""
        if isinstance(token, frozenset):
            return token if head == "" else frozenset(t for t in token if t.startswith(head))
        begun = self.beginning.get(head, ())
        if len(begun) > FEW:
            return token
        key = (token, head)
        found = self.kept.get(key)
        if found is None:
            found = frozenset(t for t in begun if self.fits(token, t))
            found = self.kept[key] = self.shared.setdefault(found, found)
        return found

    def ending(self, state: tuple, symbol: str) -> int:
        """Count from the state to the end of the word, when symbol is its last."""
        return self._follow(state, symbol, True)[1]

    # --- the automaton over characters ---
    # A state is (kind, word state before the last symbol, last symbol, apostrophe lookahead).

    def reset(self) -> None:
        """Begin with no states. Characters keep their numbers."""
        if not hasattr(self, "chars"):
            self.chars: list[int] = []
            self.dense = np.full(0x110000, -1, dtype=np.int32)
            for c in COMMON[:COLUMNS]:
                self.symbol_of(c)
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.shared: dict = {}  # equal parts of states are one object
        self.pairs.clear()
        self.kept: dict = {}
        self.rare: dict[int, tuple[int, int]] = {}
        self.next = np.full((1024, COLUMNS), -1, dtype=np.int32)
        self.emit = np.zeros((1024, COLUMNS), dtype=np.int16)
        self.closing = np.zeros(1024, dtype=np.int32)
        self.id_of((GAP, None, "", ""))

    def full(self) -> bool:
        return len(self.states) > MOST_STATES or len(self.rare) > MOST_RARE

    def id_of(self, state: tuple) -> int:
        found = self.ids.get(state)
        if found is None:
            found = self.ids[state] = len(self.states)
            self.states.append(state)
            if found >= len(self.next):
                self.next = np.pad(self.next, ((0, ROWS), (0, 0)), constant_values=-1)
                self.emit, self.closing = np.pad(self.emit, ((0, ROWS), (0, 0))), np.pad(self.closing, (0, ROWS))
            self.closing[found] = self._close(state)
        return found

    def symbol_of(self, char: int) -> int:
        found = int(self.dense[char])
        if found < 0:
            found = self.dense[char] = len(self.chars)
            self.chars.append(char)
        return found

    def kind(self, char: int) -> int:
        c = chr(char)
        category = unicodedata.category(c)
        if c.isspace() and not 0x1C <= char <= 0x1F:
            return GAP
        return LETTER if category[0] == "L" else NUMBER if category[0] == "N" else OTHER

    def _word(self, text: str) -> int:
        """Tokens of a whole word."""
        return len(self.merge(self._symbols("".join(self.of_byte[b] for b in text.encode("utf-8", "surrogatepass")) + self.end)))

    def _push(self, state: tuple | None, pending: str, char: int) -> tuple[tuple, str, int]:
        """Feed a character's bytes into a word state that holds one pending symbol back."""
        count = 0
        for b in chr(char).encode("utf-8", "surrogatepass"):
            if pending:
                state, n = self.step(state, pending)
                count += n
            pending = self.of_byte[b]
        return self.settle(state, pending), pending, count

    def _close(self, state: tuple) -> int:
        """Tokens emitted if the text ends in this state."""
        kind, word, pending, mark = state
        if kind == GAP:
            return 0
        if mark not in ("", "'"):  # "'" and letters that began a contraction but didn't end it
            return self._word("'") + self._word(mark[1:])
        return self.ending(word, pending)

    def _begin(self, char: int, kind: int) -> tuple[tuple, int]:
        """State and count after a character that begins a word."""
        if kind == GAP:
            return (GAP, None, "", ""), 0
        word, pending, count = self._push(self.START, "", char)
        if kind == NUMBER:  # each number is a word of its own
            return (GAP, None, "", ""), count + self.ending(word, pending)
        return (kind, word, pending, "'" if char == 39 else ""), count

    def transition(self, state: tuple, char: int) -> tuple[tuple, int]:
        kind, word, pending, mark = state
        new = self.kind(char)
        if mark and new == LETTER:
            seen = mark + chr(char)
            if seen in CONTRACTIONS:
                # what the apostrophe or the held letter have counted so far is taken back
                return (GAP, None, "", ""), self._word(seen)
            if mark == "'":
                if any(c.startswith(seen) for c in CONTRACTIONS):
                    return (LETTER, None, "", seen), 0
            else:  # no contraction after all: the apostrophe is a word, and the letter begins the next
                count = self._word("'")
                held, n = self._begin(ord(mark[1]), LETTER)
                after, m = self.transition(held, char)
                return after, count + n + m
        if mark not in ("", "'"):
            after, n = self._begin(char, new)
            return after, self._word("'") + self._word(mark[1:]) + n
        if kind != GAP and new == kind:
            word, pending, count = self._push(word, pending, char)
            return (kind, word, pending, ""), count
        after, n = self._begin(char, new)
        return after, n + (0 if kind == GAP else self.ending(word, pending))

    def compile(self, states: np.ndarray, symbols: np.ndarray) -> None:
        for key in np.unique(states.astype(np.int64) * (1 << 32) + symbols):
            self.follow(int(key >> 32), int(key & 0xFFFFFFFF))

    def follow(self, s: int, a: int) -> tuple[int, int]:
        """Next state and emitted count, compiled where it isn't yet."""
        if a < COLUMNS:
            to = int(self.next[s, a])
            if to >= 0:
                return to, int(self.emit[s, a])
        else:
            found = self.rare.get(s << 32 | a)
            if found is not None:
                return found
        after, count = self.transition(self.states[s], self.chars[a])
        to = self.id_of(after)
        if a < COLUMNS:
            self.next[s, a], self.emit[s, a] = to, count
        else:
            self.rare[s << 32 | a] = to, count
        return to, count

    # --- running ---

    def run(self, chunks: list[np.ndarray]) -> tuple[list[tuple], np.ndarray]:
        """Exit state and count of each chunk of symbols, in lock step, entered between words."""
        order = np.argsort([-len(c) for c in chunks], kind="stable")
        state, count = [self.states[0]] * len(chunks), np.zeros(len(chunks), dtype=np.int64)
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            lengths = np.array([len(chunks[i]) for i in lanes])
            if not lengths[0]:
                continue
            grid = np.zeros((lengths[0], len(lanes)), dtype=np.int32)
            for k, i in enumerate(lanes):
                grid[: len(chunks[i]), k] = chunks[i]
            live, others = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left"), (grid >= COLUMNS).any(axis=1)
            s, total = np.zeros(len(lanes), dtype=np.int64), np.zeros(len(lanes), dtype=np.int64)
            nxt, emit = self.next.ravel(), self.emit.ravel()
            for row, n, other in zip(grid, live, others, strict=True):
                if other:
                    # characters without a column, each pair of a state and a character once
                    which = row[:n] >= COLUMNS
                    keys, back = np.unique(s[:n][which] << 32 | row[:n][which], return_inverse=True)
                    found = np.array([self.follow(k >> 32, k & 0xFFFFFFFF) for k in keys.tolist()], dtype=np.int64).reshape(-1, 2)[back]
                    nxt, emit = self.next.ravel(), self.emit.ravel()
                flat = s[:n] * COLUMNS + np.where(row[:n] < COLUMNS, row[:n], 0) if other else s[:n] * COLUMNS + row[:n]
                to = nxt[flat]
                if to.min() < 0:
                    missing = to < 0 if not other else (to < 0) & ~which
                    self.compile(s[:n][missing], row[:n][missing])
                    nxt, emit = self.next.ravel(), self.emit.ravel()
                    to = nxt[flat]
                grown = emit[flat]
                if other:
                    to[which] = found[:, 0]
                    grown = grown.astype(np.int64)
                    grown[which] = found[:, 1]
                total[:n] += grown
                s[:n] = to
                if self.full():
                    held = [self.states[i] for i in s.tolist()]
                    self.reset()
                    s[:] = [self.id_of(x) for x in held]
                    nxt, emit = self.next.ravel(), self.emit.ravel()
            for i, x in zip(lanes.tolist(), s.tolist(), strict=True):
                state[i] = self.states[x]
            count[lanes] = total
        return state, count

    def normalise(self, text: str) -> str:
        """The library's normaliser. Latin letters are composed already and lower-case alike in Python, much faster."""
        if text.isascii() or (max(text) < "\u0250" and "\u0130" not in text):
            return text.lower()
        return self.library.normalizer.normalize_str(text)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text."""
        totals = [0] * len(texts)
        owner, chunks = [], []
        for i, text in enumerate(texts):
            for k, piece in enumerate(self._split(text)):
                totals[i] += k > 0  # the special token before it
                codes = np.frombuffer(self.normalise(piece).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                if not len(codes):
                    continue
                symbols = self.dense[codes]
                if (symbols < 0).any():
                    for c in np.unique(codes[symbols < 0]):
                        self.symbol_of(int(c))
                    symbols = self.dense[codes]
                cuts = range(0, len(symbols), CHUNK)
                owner.append((i, len(chunks), len(chunks) + len(cuts)))
                chunks.extend(symbols[c : c + CHUNK] for c in cuts)
        maps = self._maps(chunks)
        for i, a, b in owner:
            totals[i] += self._apply(self._reduce(maps[a:b]))
        return totals

    def _split(self, text: str) -> list[str]:
        """The texts between special tokens, which the library finds before all else."""
        parts = [text]
        if "<|" in text:
            import regex

            parts = regex.split("|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)), text)
        return parts

    # a map is (head symbols, has a boundary, exit state itself, count of the rest)

    def _maps(self, chunks: list[np.ndarray]) -> list[tuple]:
        gaps = np.array([self.kind(c) == GAP for c in self.chars] or [False])
        heads = []
        for c in chunks:
            at = int(np.argmax(gaps[c]))
            heads.append(at if gaps[c[at]] else len(c))
        state, count = self.run([c[h:] for c, h in zip(chunks, heads, strict=True)])
        return [(c[:h], h < len(c), s, int(n)) for c, h, s, n in zip(chunks, heads, state, count, strict=True)]

    def _reduce(self, maps: list[tuple]) -> tuple:
        """Compose neighbours until one map is left."""
        while len(maps) > 1:
            maps = [self._compose(maps[i], maps[i + 1]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def _compose(self, a: tuple, b: tuple) -> tuple:
        if not a[1]:
            return (np.concatenate((a[0], b[0])), b[1], b[2], b[3])
        state, count = self._walk(a[2], b[0])
        if b[1]:  # at the boundary the pending word is closed, and what follows is as from between words
            return (a[0], True, b[2], a[3] + count + self._close(state) + b[3])
        return (a[0], True, state, a[3] + count)

    def _walk(self, state: tuple, symbols: np.ndarray) -> tuple[tuple, int]:
        count, at = 0, self.id_of(state)
        for a in symbols.tolist():
            at, n = self.follow(at, a)
            count += n
            if self.full():
                state = self.states[at]
                self.reset()
                at = self.id_of(state)
        return self.states[at], count

    def _apply(self, m: tuple) -> int:
        """Tokens of a whole text with this map: entered between words, closed at its end."""
        state, count = self._walk((GAP, None, "", ""), m[0])
        if m[1]:
            return count + self._close(state) + m[3] + self._close(m[2])
        return count + self._close(state)


_COMPILED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of docs; no shuffle.

    Counts are those of the tokenizer file's library, without added tokens; special strings in
    texts count as their special token. Null and empty texts have 0 bytes and 0 tokens. Repeated
    rows repeat; other columns are ignored; doc_id may be null. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for b in batches:
            at = 0
            texts = b.column(1).to_pylist()
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and size < TOGETHER:
                    size += len(texts[to] or "")
                    to += 1
                counts = machine.count([t or "" for t in texts[at:to]])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])
                at = to

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long"
    sized = bounded(docs).select("doc_id", "text").mapInArrow(_with_bytes(run), schema.replace("n_tokens", "n_bytes long, n_tokens"))
    return sized.withColumn("over_limit", F.col("n_tokens") > limit)


def _with_bytes(run):
    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for b in batches:
            n = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            at = 0
            for out in run(iter([b])):
                yield pa.RecordBatch.from_arrays([out.column(0), n.slice(at, out.num_rows), out.column(1)], names=["doc_id", "n_bytes", "n_tokens"])
                at += out.num_rows

    return outer
