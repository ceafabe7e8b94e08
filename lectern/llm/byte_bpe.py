"""Byte-level BPE: a lazily determinised transducer encodes, an incremental UTF-8 machine decodes.

Encoding. Two facts make BPE finite-state: the encoding of every prefix that ends on a token boundary is a prefix of
the whole encoding, and a token sequence is a BPE encoding exactly if each neighbouring pair is what the merges make of
its bytes. The nondeterministic machine therefore keeps, for each place where the token now being read may have begun,
the trie node of its bytes and the tokens before it. The determinised machine's states are tuples of these items with
their pending tokens; what all items share is emitted at once, so the lookahead is bounded by the longest token.
Pair checks are made when first met; a state is kept from the second time on that it is reached, as most are met in one rare
word and never again; states are dropped together when there are too many. Encoded pieces are remembered in two halves: a full young half becomes the old one, and what is met again moves back, so frequent pieces
stay however many rare ones pass. Results leave each task in small batches.

Decoding. Tokens are bytes; a character may be cut between two of them. The decoder's state is the unfinished
character (at most three bytes); its moves by token are memoised in the same lazy way. A piece's ids always end with a
whole character, so what they decode to is remembered with them (where it is the piece, as that), and a text's is the
pieces' in order.

Defined cases: null text counts as empty: no tokens, digests of the empty string; repeated rows each get their result;
an empty table gives an empty result; other columns are ignored; bytes that are not UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import chain
from operator import itemgetter
from threading import Timer

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import whole_text

MEMO = 200_000  # entries of a memo's half, or of the pair checks, before they are dropped
STATES = 200_000  # states of the determinised machine before it starts anew
MET = 1 << 20  # marks, by hash, of states that were reached once; all are taken back when half as many were set
BLOCK = 8192  # pieces of a text that are looked up at once
OUT_ROWS, OUT_IDS = 1024, 1 << 20  # a batch of results ends with so many rows or ids


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


NO_MORE: dict[int, Step] = {}


class State:
    """A state of the determinised machine: its items, one after the other (trie node, token before, pending tokens; the
    last one stands at a boundary), and its moves by byte. Most states have one; it needs no dictionary."""

    __slots__ = ("items", "byte", "step", "more")

    def __init__(self, items: tuple):
        self.items, self.byte, self.step, self.more = items, -1, None, NO_MORE

    def __len__(self) -> int:
        return bool(self.items) + (self.step is not None) + len(self.more)

    def forget(self) -> None:
        self.items, self.byte, self.step, self.more = (), -1, None, NO_MORE

    def learn(self, byte: int, step: Step) -> None:
        if self.step is None:
            self.byte, self.step = byte, step
        elif self.more is NO_MORE:
            self.more = {byte: step}
        else:
            self.more[byte] = step


Step = tuple[tuple[int, ...], State]  # tokens emitted by a move, and the state reached


class Encoder:
    """Text to ids by a rank table and a splitting pattern; one per Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.children: list[dict[int, int]] = [{}]  # byte trie; node 0 is the root
        self.token_at: list[int] = [-1]
        for word, rank in ranks.items():
            node = 0
            for b in word:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = rank
        self.bytes_of = {rank: word for word, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.chunks = Remembered(self._chunk)
        self.older: dict[str, Known] = {}
        self.decoder, self.numbers = Decoder(self.bytes_of), Numbers()
        self.by_letters = RUNS in pattern
        self.met, self.n_met = bytearray(MET), 0
        self._reset()

    def _reset(self) -> None:
        for state in getattr(self, "states", {}).values():  # states point at each other: emptied, they go at once
            state.forget()
        self.states: dict[tuple, State] = {}
        self.start = self._state((0, -1, ()))

    def close(self) -> None:
        """Drop all that was remembered, and the way back from it; it can't be used any more."""
        for state in self.states.values():
            state.forget()
        for held in (self.states, self.pairs, self.halves, self.chunks, self.older):
            held.clear()
        del self.chunks.make

    def _state(self, items: tuple) -> State:
        state = self.states.get(items)
        if state is None:
            state = self.states[items] = State(items)
        return state

    def _first_time(self, items: tuple) -> bool:
        """Whether a state is not known to have been reached; from now on it is. One that shares its mark counts as reached."""
        at = hash(items) % MET
        if self.met[at]:
            return False
        if self.n_met >= MET // 2:
            self.met, self.n_met = bytearray(MET), 0
        self.met[at] = 1
        self.n_met += 1
        return True

    def merged(self, word: bytes, stop: int = 1) -> list[int]:
        """What the merges make of a short word, the lowest rank first, the leftmost of equals, down to ``stop`` parts."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > stop:
            ranked = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one; a byte, or a token that no merges make, is its own halves."""
        known = self.halves.get(token)
        if known is None:
            parts = self.merged(self.bytes_of[token], 2)
            known = self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else (token, token)
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave this pair of tokens (or a single token, ``left`` -1) as it is.

        The merges are undone from the last one: the two tokens stay apart unless, at some time, the parts that then
        touched made a token of a rank below the merge that came next (of equal ranks the left one comes first).
        """
        known = self.pairs.get((left, right))
        if known is None:
            known = self.merged(self.bytes_of[right]) == [right] if left < 0 else self._apart(left, right)
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        a, b, next_merge = left, right, 1 << 60
        while True:
            if self.ranks.get(self.bytes_of[a] + self.bytes_of[b], 1 << 60) < next_merge:
                return False
            last_left, last_right = self._halves(a)[1], self._halves(b)[0]
            if last_left == a and last_right == b:
                return True
            # undo the later of the two merges; of one rank, the right one came later
            if last_right == b or (last_left != a and a > b):
                a, next_merge = last_left, a
            else:
                b, next_merge = last_right, b + 1

    def _move(self, state: State, byte: int) -> Step:
        items, at_end, children, token_at, pairs = [], None, self.children, self.token_at, self.pairs
        parts = iter(state.items)
        for node, before, pending in zip(parts, parts, parts):
            nxt = children[node].get(byte)
            if nxt is None:
                continue
            token = token_at[nxt]
            if token >= 0 and at_end is None:
                apart = pairs.get((before, token))
                if self.compatible(before, token) if apart is None else apart:
                    at_end = (0, token, (*pending, token))
            if children[nxt]:
                items.append((nxt, before, pending))
        items.append(at_end)
        if len(items) == 1:
            out, reached = at_end[2], (0, at_end[1], ())
        else:
            first, shared = items[0][2], 0
            for k, token in enumerate(first):  # the first item is the oldest
                if not all([len(p) > k and p[k] == token for _, _, p in items]):
                    break
                shared += 1
            if shared:
                items = [(n, b, p[shared:]) for n, b, p in items]
            out, reached = first[:shared], tuple(chain.from_iterable(items))
        if reached not in self.states and self._first_time(reached):
            return out, State(reached)  # no state points at it, so it goes with the word
        step = out, self._state(reached)
        state.learn(byte, step)
        return step

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """Ids of one match of the pattern; a word that is a token stays whole."""
        whole = self.ranks.get(word)
        if whole is not None:
            return (whole,)
        if len(self.states) >= STATES:
            self._reset()
        out: list[int] = []
        at = self.start
        for byte in word:
            emitted, at = (at.step if at.byte == byte else at.more.get(byte)) or self._move(at, byte)
            if emitted:
                out += emitted
        out += at.items[-1]
        return tuple(out)

    def _keep(self, piece: str, known: Known) -> Known:
        if len(piece) <= 32:
            if len(self.chunks) >= MEMO:
                self.older = dict(self.chunks)
                self.chunks.clear()
            self.chunks[piece] = known
        return known

    def _again(self, piece: str) -> Known | None:
        known = self.older.get(piece)
        return known and self._keep(piece, known)

    def _encoded(self, word: str) -> Known:
        """A match's ids by the machine, and what the decoder makes of them."""
        ids = self.encode_word(word.encode())
        text = self.decoder.whole_text(ids)
        numbers = ",".join(map(self.numbers.__getitem__, ids))
        return numbers if text == word else (numbers, text)

    def _word(self, word: str) -> Known:
        return self.chunks.get(word) or self._again(word) or self._keep(word, self._encoded(word))

    def _chunk(self, chunk: str) -> Known:
        known = self._again(chunk)
        if known:
            return known
        if self.by_letters and (found := PLAIN.fullmatch(chunk)):
            letters, marks = found.groups()
            if not marks:
                return self._keep(chunk, self._encoded(chunk))
            return self._keep(chunk, known_as(chunk, *joined([letters, marks], [self._word(letters), self._word(marks)])))
        if "\n" in chunk:  # a lone line end is a match of its own, and so parts what stands around it
            lines = LONE_LINE.split(chunk)
            if len(lines) > 1:
                pieces, parts = [], []
                for k, line in enumerate(lines):
                    if k:
                        pieces.append("\n")
                        parts.append(self._word("\n"))
                    pieces.append(line)
                    parts.append(self.chunks.get(line) or self._chunk(line))
                return known_as(chunk, *joined(pieces, parts))
        words = self.pattern.findall(chunk)
        if len(words) == 1:
            return self._keep(chunk, self._encoded(chunk))
        return self._keep(chunk, known_as(chunk, *joined(words, [self._word(word) for word in words])))

    def blocks_of(self, text: str) -> Iterator[tuple[list[str], list[Known]]]:
        """The text's pieces, and what they are encoded and decoded to, a block at a time. A lone space between two visible symbols always
        begins a match, so the pieces that such spaces begin can be encoded, and remembered, by themselves."""
        first, *rest = text.split(" ") if only_lone_spaces(text) else LONE_SPACE.split(text)
        for at in range(0, len(rest) + 1, BLOCK):
            pieces = [" " + piece for piece in rest[max(at - 1, 0):at + BLOCK - 1]]
            if at == 0 and first:
                pieces.insert(0, first)
            if pieces:
                yield pieces, list(map(self.chunks.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        return [i for block in self.blocks_of(text) for i in ids_of(joined(*block)[0])]


# Of a piece: its ids joined by commas; with the text that they decode to, unless that is the piece itself.
Known = str | tuple[str, str]


def joined(pieces: list[str], known: list[Known]) -> tuple[str, str]:
    """Ids and decoded text of pieces that follow each other."""
    try:
        return ",".join(known), "".join(pieces)
    except TypeError:  # a piece that decodes to another text
        pairs = [k if isinstance(k, tuple) else (k, piece) for piece, k in zip(pieces, known)]
        return ",".join([numbers for numbers, _ in pairs]), "".join([text for _, text in pairs])


class Remembered(dict):
    """What pieces are encoded and decoded to; one that is not there is made, and its maker keeps it or not."""

    def __init__(self, make: Callable[[str], Known]):
        self.make = make

    def __missing__(self, piece: str) -> Known:
        return self.make(piece)


class Numbers(dict):
    """Decimal form of an id."""

    def __missing__(self, i: int) -> str:
        value = self[i] = str(i)
        return value


def known_as(piece: str, numbers: str, text: str) -> Known:
    return numbers if text == piece else (numbers, text)


def ids_of(numbers: str) -> Iterator[int]:
    return map(int, numbers.split(","))


LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
LONE_LINE = re.compile(r"(?<=\S)\n(?=\S)")
MIXED_SPACE = re.compile(r"\s | \s")
RUNS = r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"  # in a pattern: letters, and then marks, are a match each
# letters and marks in all versions of Unicode; an apostrophe may begin another match
PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)")


def only_lone_spaces(text: str) -> bool:
    """Whether each space stands between two visible symbols."""
    if text[:1] == " " or text[-1:] == " " or "  " in text or "\n " in text or " \n" in text:
        return False
    # of white space, only the space is printable
    return text.replace("\n", "").isprintable() or not MIXED_SPACE.search(text)


def utf8_step(pending: bytes, more: bytes) -> tuple[str, bytes]:
    """Characters completed by ``more`` after the unfinished ``pending``, and the bytes left unfinished."""
    data = pending + more
    cut = len(data)
    for back in range(1, min(3, len(data)) + 1):  # find a last lead byte whose sequence is not complete
        b = data[-back]
        if b & 0xC0 == 0x80:
            continue
        need = 4 if b >= 0xF0 else 3 if b >= 0xE0 else 2 if b >= 0xC0 else 1
        if need > back and b < 0xF8:
            cut = len(data) - back
        break
    return data[:cut].decode("utf-8", "replace"), data[cut:]


class WholeTokens(dict):
    """Text of a token that ends with a whole character, else None."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of

    def __missing__(self, i: int) -> str | None:
        text, rest = utf8_step(b"", self.bytes_of[i])
        value = self[i] = None if rest else text
        return value


class Decoder:
    """Ids to text as a stream: ``feed`` gives what is complete, ``finish`` the rest."""

    def __init__(self, bytes_of: dict[int, bytes], moves: dict | None = None, whole: dict | None = None):
        self.bytes_of, self.pending = bytes_of, b""
        self.moves = {} if moves is None else moves
        self.whole = WholeTokens(bytes_of) if whole is None else whole

    def feed(self, ids: Sequence[int]) -> str:
        out, moves = [], self.moves
        for at in range(0, len(ids), 64):
            run = ids[at:at + 64]
            if not self.pending:  # as long as no character is open, a token of whole characters leaves it so
                texts = list(map(self.whole.__getitem__, run))
                if None not in texts:
                    out += texts
                    continue
            pending = self.pending
            for i in run:
                step = moves.get((pending, i))
                if step is None:
                    step = utf8_step(pending, self.bytes_of[i])
                    if len(moves) >= MEMO:
                        moves.clear()
                    moves[pending, i] = step
                out.append(step[0])
                pending = step[1]
            self.pending = pending
        return "".join(out)

    def whole_text(self, ids: Sequence[int]) -> str:
        """Text of ids that stand by themselves."""
        try:
            return "".join(map(self.whole.__getitem__, ids))
        except TypeError:  # a token that ends within a character
            return self.feed(ids) + self.finish()

    def finish(self) -> str:
        rest, self.pending = self.pending.decode("utf-8", "replace"), b""
        return rest


IDLE_S = 2.0  # a worker's encoder goes when no task has used it for so long
_ENCODERS: dict[str, Encoder] = {}  # those not in use
_LEAVING: dict[str, Timer] = {}


def _drop(key: str) -> None:
    held = _ENCODERS.pop(key, None)
    if held is not None:
        held.close()


@contextmanager
def encoder(ranks: bytes, pattern: str) -> Iterator[Encoder]:
    """The worker's encoder for a rank file's content, for one task after the other; it goes soon after the last, so that a
    worker that lives on for other operators holds none of its memory. What it remembers has no cycles but those that
    ``close`` cuts; while a task uses it the collector would only walk over it."""
    key, collects = hashlib.sha256(ranks + pattern.encode()).hexdigest(), gc.isenabled()
    if key in _LEAVING:
        _LEAVING.pop(key).cancel()
    enc = _ENCODERS.pop(key, None)
    if enc is None:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        enc = Encoder(table, pattern)
    gc.disable()
    try:
        yield enc
    finally:
        if collects:
            gc.enable()
        _ENCODERS[key] = enc
        timer = _LEAVING[key] = Timer(IDLE_S, _drop, [key])
        timer.daemon = True
        timer.start()


def digests(text: str, enc: Encoder, with_ids: bool) -> tuple:
    """(number of ids, their digest, digest of the decoded text[, ids]); a very long text passes in blocks."""
    sha_ids, sha_text, n, ids = hashlib.sha256(), hashlib.sha256(), 0, array("i")
    for block in enc.blocks_of(text):
        numbers, decoded = joined(*block)
        sha_ids.update((("," if n else "") + numbers).encode())
        sha_text.update(decoded.encode())
        n += numbers.count(",") + 1
        if with_ids:
            ids.extend(ids_of(numbers))
    return n, sha_ids.hexdigest(), sha_text.hexdigest(), *([ids] if with_ids else [])


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
                with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row.

    The rank file is read on the driver and broadcast: its size is that of the vocabulary, whatever the corpus.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(shared.value, pattern) as enc:
            for batch in batches:
                keys, texts, begin, rows = batch.column("_key"), batch.column("_text"), 0, []
                for at, text in enumerate(texts, 1):
                    rows.append(digests(text.as_py(), enc, with_ids))
                    if at == len(texts) or len(rows) >= OUT_ROWS or with_ids and sum(map(itemgetter(0), rows)) >= OUT_IDS:
                        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                        yield pa.RecordBatch.from_arrays([keys.slice(begin, at - begin), *columns], names=names)
                        begin, rows = at, []

    kinds = [pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32())] if with_ids else [])]
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    return docs.select(F.col(key).alias("_key"), whole_text(text).alias("_text")).mapInArrow(run, schema)
