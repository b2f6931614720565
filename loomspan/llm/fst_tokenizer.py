"""Byte-level BPE compiled to finite-state transducers.

Two deterministic transducers run one after the other:

* The *splitter* reads character classes and annotates each transition with the pretoken starts that it settles (at the character just read, or at the one
  before it, as the white-space rule looks one character ahead). A text of any length is cut into chunks of fixed length; each chunk yields a map from every
  possible entry state to its exit state, and a prefix scan composes the maps, so that all chunks then run at once from their true entry states.
* The *merger* reads the bytes of a pretoken and annotates each transition with the change in the number of emitted tokens. It rests on two facts about BPE:
  a prefix of a pretoken has one tokenization, and a token sequence is the tokenization of its bytes exactly if each adjacent pair is one of its own bytes.
  A state is the longest suffix that can still start a token, with the last token (and the relative count) at each place where such a token may start.
  States are compiled when first met. At a pretoken start the merger returns to its root, so runs of pretokens are independent chunks.

Results equal the tokenizer library's: added special strings inside texts are single tokens, nothing is added, truncated or padded.
Nulls count as empty texts.
"""

from __future__ import annotations

import json
import unicodedata
from array import array

import numpy as np

# Code points with the Unicode White_Space property.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]

#: Character classes of the splitter.
LETTER, SHORT, R, V, EL, E, NUMBER, OTHER, QUOTE, SPACE, WHITE, END = range(12)
#: States of the splitter. FRESH: the next character starts a pretoken. Q*: a quote that starts a pretoken, and what follows it.
FRESH, IN_L, IN_N, IN_O, SPACE_1, SPACE_N, WHITE_1, WHITE_N, Q, Q_R, Q_V, Q_L = range(12)
#: What a transition settles: a start at the character just read, a start at the one before.
HERE, BEFORE = 1, 2

#: Rank of pairs that no merge joins.
NEVER = 1 << 60

CHUNK = 64
RUN = 160


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    go, out = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    letters = (LETTER, SHORT, R, V, EL, E)

    def opens(c: int) -> int:
        """State after c where c starts a pretoken."""
        return IN_L if c in letters else {NUMBER: IN_N, OTHER: IN_O, QUOTE: Q, SPACE: SPACE_1, WHITE: WHITE_1, END: FRESH}[c]

    def joins(c: int) -> int:
        """State after c where c continues the pretoken that a single space opened."""
        return IN_L if c in letters else IN_N if c == NUMBER else IN_O

    for c in range(12):
        white = c in (SPACE, WHITE)
        for s in range(12):
            go[s, c], out[s, c] = opens(c), HERE
        if c == END:
            out[[Q_R, Q_V, Q_L], c] |= BEFORE
            continue
        if c in letters:
            go[IN_L, c], out[IN_L, c] = IN_L, 0
        if c == NUMBER:
            go[IN_N, c], out[IN_N, c] = IN_N, 0
        if c in (OTHER, QUOTE):
            go[IN_O, c], out[IN_O, c] = IN_O, 0
            go[Q, c], out[Q, c] = IN_O, 0
        for s in (SPACE_1, SPACE_N, WHITE_1, WHITE_N):
            if white:
                go[s, c], out[s, c] = (SPACE_N if c == SPACE else WHITE_N), 0
            elif s == SPACE_1:
                go[s, c], out[s, c] = joins(c), 0
            elif s == SPACE_N:
                go[s, c], out[s, c] = joins(c), BEFORE
            elif s == WHITE_N:
                out[s, c] |= BEFORE
        if c == SHORT:
            go[Q, c], out[Q, c] = FRESH, 0
        for s, first, last in ((Q_R, R, E), (Q_V, V, E), (Q_L, EL, EL)):
            if c == first:
                go[Q, c], out[Q, c] = s, 0
            if c == last:
                go[s, c], out[s, c] = FRESH, 0
            elif c in letters:
                go[s, c], out[s, c] = IN_L, BEFORE
            else:
                out[s, c] |= BEFORE
    return go.reshape(-1), out.reshape(-1)


def _classes() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        k = unicodedata.category(chr(i))[0]
        if k == "L":
            kinds[i] = LETTER
        elif k == "N":
            kinds[i] = NUMBER
    kinds[WHITE_SPACE] = WHITE
    for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", SHORT), ("r", R), ("v", V), ("l", EL), ("e", E)):
        kinds[[ord(c) for c in chars]] = kind
    return kinds


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class FstTokenizer:
    """Counts and ids of a byte-level BPE vocabulary in the JSON format of the tokenizers library.

    max_states bounds the compiled merger (about 0.3 kB a state): beyond it those that texts meet least are forgotten, to be compiled anew when they are next met.
    """

    def __init__(self, path: str, max_states: int = 300_000):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        chars = _byte_chars()
        special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        to_bytes = lambda s: bytes(chars[c] for c in s)
        self.special = special
        self.ids = {to_bytes(k): v for k, v in data["model"]["vocab"].items() if k not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        self.ranks = {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        size = max(self.ids.values()) + 1
        self.token = [b""] * size
        for k, v in self.ids.items():
            self.token[v] = k
        self.token_len = np.array([len(t) for t in self.token], np.int64)
        self.starts = {t[:i] for t in self.ids for i in range(len(t))}
        self.go, self.out = _splitter()
        self.kinds = _classes()
        self.max_states = max_states
        made = {a + b: i for (a, b), i in self.ranks.items()}  # the last merge that makes a token
        self.ascending = all(made.get(x, -1) < i for pair, i in self.ranks.items() for x in pair)
        self.sides: dict[int, tuple[list, list] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.known: dict[bytes, int] = {}
        self.keys: list[bytes] = []
        self.last, self.met = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32)
        self._table(np.zeros(0, np.int64), 16)
        self.root = self._number(b"\0\0" + array("i", (0, size, 0)).tobytes())

    # The merger, compiled on demand.

    def _merge(self, word: bytes) -> list[int]:
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(p, NEVER), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ids[p] for p in parts]

    def _sides(self, token: int) -> tuple[list, list] | None:
        """How a token's last and first parts grow as it is merged: (part, rank of the merge that ends it), the whole token last; None for a token that its own bytes don't give."""
        if (known := self.sides.get(token, False)) is not False:
            return known
        parts = [self.token[token][i : i + 1] for i in range(len(self.token[token]))]
        ends, begins = [], []
        while len(parts) > 1:
            rank, i = min((self.ranks.get(p, NEVER), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == NEVER:
                break
            if i == len(parts) - 2:
                ends.append((parts[-1], rank))
            if i == 0:
                begins.append((parts[0], rank))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out = ([*ends, (parts[0], NEVER)], [*begins, (parts[0], NEVER)]) if len(parts) == 1 and parts[0] in self.ids else None
        self.sides[token] = out
        return out

    def _fits(self, before: int, token: int) -> bool:
        """Whether token, after the start or after another token, is what merging gives.

        Merges go by rank, and where each merge's parts have lesser ranks, in ascending ranks. So two tokens stay apart unless parts of theirs that meet at the boundary
        have a merge that comes before those that end these parts; of equal ranks the left one comes first.
        """
        if len(self.pairs) > 300_000:
            self.pairs.clear()
        own = self._sides(token)
        if before == len(self.token) or own is None:
            known = own is not None
        elif self.ascending:
            known, i, j = True, 0, 0
            left, right = self._sides(before)[0], own[1]
            while True:
                (a, t), (b, u) = left[i], right[j]
                rank = self.ranks.get((a, b), NEVER)
                if rank < t and rank <= u and rank != NEVER:
                    known = False
                    break
                if t == u == NEVER:
                    break
                i, j = (i + 1, j) if t <= u else (i, j + 1)
        else:
            known = self._merge(self.token[before] + self.token[token]) == [before, token]
        self.pairs[before << 20 | token] = known
        return known

    def _evict(self, state: np.ndarray) -> np.ndarray:
        """Forgets the states that were met least, with at most half of max_states left, but neither the root nor these, whose new numbers it gives."""
        n = len(self.keys)
        kept = np.zeros(n, bool)
        kept[np.argsort(-self.met[:n], kind="stable")[: self.max_states // 2]] = True
        kept &= self.met[:n] > 0
        kept[state] = kept[self.root] = True
        number = np.cumsum(kept) - 1
        old = self.slots[self.slots != -1]
        old = old[kept[old >> 40] & kept[(old & 0xFFFFFFFF) >> 8]]
        steps = (number[old >> 40] << 8 | old >> 32 & 255) << 32 | number[(old & 0xFFFFFFFF) >> 8] << 8 | old & 255
        self.keys = [key for key, own in zip(self.keys, kept.tolist(), strict=True) if own]
        self.known = {key: i for i, key in enumerate(self.keys)}
        last, met = self.last[:n][kept], self.met[:n][kept] // 2
        self.last, self.met = np.zeros_like(self.last), np.zeros_like(self.met)
        self.last[: len(last)], self.met[: len(met)] = last, met
        self.root = int(number[self.root])
        self._table(steps, 16)
        return number[state]

    def _table(self, steps: np.ndarray, bits: int) -> None:
        """Puts transitions into a new table, at most half of it full."""
        while len(steps) * 2 > 1 << bits:
            bits += 1
        self.bits, self.filled = bits, len(steps)
        self.slots = np.full(1 << bits, -1, np.int64)
        at = ((steps >> 32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
        left = np.arange(len(steps))
        while len(left):
            free = left[self.slots[at[left]] == -1]
            place, first = np.unique(at[free], return_index=True)
            self.slots[place] = steps[free[first]]
            left = left[self.slots[at[left]] != steps[left]]
            at[left] = at[left] + 1 & (1 << bits) - 1

    def _number(self, key: bytes) -> int:
        """A state's number. key: the length of its suffix and the suffix, then its chain: for each place that many bytes back where a token may start, the last token there and its count
        against the present one."""
        if (s := self.known.get(key)) is None:
            s = self.known[key] = len(self.keys)
            self.keys.append(key)
            if s >= len(self.last):
                self.last, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.last, self.met))
            first = 2 + int.from_bytes(key[:2], "little")  # the chain's first place is 0, where the last token ends
            self.last[s] = int.from_bytes(key[first + 4 : first + 8], "little")
        return s

    def _compile(self, state: int, byte: int) -> int:
        """Packed transition: next state, change of count plus 128."""
        key = self.keys[state]
        n = int.from_bytes(key[:2], "little")
        suffix, flat = key[2 : 2 + n], array("i", key[2 + n :])
        chain = list(zip(flat[::3], flat[1::3], flat[2::3], strict=True))  # places in ascending distance
        read = suffix + bytes([byte])
        end, ids, pairs, starts = len(read) - 1, self.ids, self.pairs, self.starts
        for back, before, count in reversed(chain):
            token = ids.get(read[end - back :])
            if token is None:
                continue
            fits = pairs.get(before << 20 | token)
            if self._fits(before, token) if fits is None else fits:
                break
        else:
            raise ValueError("the vocabulary lacks single bytes")
        change, i = count + 1, 0
        while read[i:] not in starts:
            i += 1
        rest = read[i:]
        flat = array("i", (0, token, 0))
        for back, before, count in chain:
            if back + 1 > len(rest):
                break
            if read[end - back :] in starts:
                flat.extend((back + 1, before, count - change))
        return self._number(len(rest).to_bytes(2, "little") + rest + flat.tobytes()) << 8 | change + 128

    def _slot(self, key: int) -> int:
        h = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        while (v := int(self.slots[h])) != -1 and v >> 32 != key:
            h = (h + 1) & (1 << self.bits) - 1
        return h

    def _step(self, key: int) -> int:
        """Packed transition of key (state and byte), compiled if it is new."""
        h = self._slot(key)
        if self.slots[h] != -1:
            return int(self.slots[h]) & 0xFFFFFFFF
        packed = self._compile(key >> 8, key & 255)
        self.filled += 1
        if self.filled * 2 > 1 << self.bits:
            self._table(self.slots[self.slots != -1], self.bits + 1)
            self.filled += 1
            h = self._slot(key)
        self.slots[h] = key << 32 | packed
        return packed

    def _steps(self, keys: np.ndarray) -> np.ndarray:
        h = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.slots[h]
        bad = np.flatnonzero(found >> 32 != keys)
        mask = (1 << self.bits) - 1
        while len(bad):
            new = bad[found[bad] == -1]
            if len(new):
                values, back = np.unique(keys[new], return_inverse=True)
                bits = self.bits
                packed = np.array([self._step(k) for k in values.tolist()], np.int64)
                found[new] = keys[new] << 32 | packed[back]
                if bits != self.bits:
                    rest = bad[found[bad] >> 32 != keys[bad]]
                    if len(rest):
                        found[rest] = self._steps(keys[rest])
                    return found
            bad = bad[found[bad] >> 32 != keys[bad]]
            h[bad] = h[bad] + 1 & mask
            found[bad] = self.slots[h[bad]]
            bad = bad[found[bad] >> 32 != keys[bad]]
        return found

    # Running both over many texts at once.

    def _starts(self, kinds: np.ndarray) -> np.ndarray:
        """Which characters start a pretoken. kinds: the classes, END after each text."""
        n = -(-len(kinds) // CHUNK)
        padded = np.full(n * CHUNK, END, np.uint8)
        padded[: len(kinds)] = kinds
        by_step = np.ascontiguousarray(padded.reshape(n, CHUNK).T)
        maps = np.repeat(np.arange(12, dtype=np.uint8)[:, None], n, axis=1)  # entry state, chunk -> state
        for column in by_step:
            maps = self.go[maps * np.uint8(12) + column]
        d = 1
        while d < n:  # the map of all chunks up to each one
            maps[:, d:] = np.take_along_axis(maps[:, d:], maps[:, :-d].astype(np.intp), axis=0) if d < n else maps[:, d:]
            d *= 2
        state = np.concatenate([[np.uint8(FRESH)], maps[FRESH, :-1]]).astype(np.uint8)
        settled = np.empty((CHUNK, n), np.uint8)
        for k, column in enumerate(by_step):
            i = state * np.uint8(12) + column
            settled[k] = self.out[i]
            state = self.go[i]
        flat = settled.T.reshape(-1)[: len(kinds)]
        starts = (flat & HERE).astype(bool)
        starts[:-1] |= (flat[1:] & BEFORE).astype(bool)
        return starts

    def _run(self, texts: list[str], with_last: bool):
        """Both transducers over the texts, each followed by a line feed that stands for its end.

        Returns the number of tokens of each text, or with with_last: bytes, pretoken starts, last token at each byte, text ends.
        """
        joined = "\n".join([*texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kinds = self.kinds[points]
        kinds[np.cumsum([len(t) + 1 for t in texts]) - 1] = END
        starts = self._starts(kinds)
        data = np.frombuffer(joined.encode(), np.uint8)
        lead = np.flatnonzero(data & 0xC0 != 0x80)
        first = np.zeros(len(data) + 1, bool)
        first[lead] = starts
        first[-1] = True
        ends = lead[kinds == END]
        places = np.flatnonzero(first)
        # Runs of about RUN bytes that begin at pretoken starts and stay within a text, its end left out.
        begins = np.concatenate([[0], ends[:-1] + 1])
        inner = places[np.unique(np.searchsorted(places, np.arange(0, len(data), RUN)))]
        cuts = np.unique(np.concatenate([begins, inner[inner < len(data)]]))
        owner = np.searchsorted(ends, cuts)
        sizes = np.minimum(np.append(cuts[1:], len(data)), ends[owner]) - cuts
        order = np.argsort(-sizes, kind="stable")
        cuts, sizes, owner = cuts[order], sizes[order], owner[order]
        live = int(np.searchsorted(-sizes, 0))
        state = np.full(live, self.root, np.int64)
        total = np.zeros(live, np.int64)
        last = np.zeros(len(data) if with_last else 0, np.int32)
        k0 = 0
        while live:
            steps = int(min(64, sizes[0] - k0))
            at = np.minimum(cuts[:live] + np.arange(k0, k0 + steps)[:, None], len(data) - 1)
            read, new = data[at], first[at]
            after = np.zeros(at.shape, np.int32) if with_last else None
            for k in range(steps):
                live = int(np.searchsorted(-sizes[:live], -(k0 + k)))
                if len(self.keys) >= self.max_states:
                    state[:live] = self._evict(state[:live])
                now = np.where(new[k, :live], self.root, state[:live])
                found = self._steps(now << 8 | read[k, :live])
                state[:live] = (found & 0xFFFFFFFF) >> 8
                total[:live] += (found & 255) - 128
                if not k % 8:  # a sample of places tells well enough which states are common
                    self.met[state[:live]] += 1
                if with_last:
                    after[k, :live] = self.last[state[:live]]
            if with_last:
                done = np.arange(k0, k0 + steps)[:, None] < sizes[: at.shape[1]]
                last[at[done]] = after[done]
            k0 += steps
            live = int(np.searchsorted(-sizes[:live], -k0))
        counts = np.bincount(owner[: len(total)], total, len(texts)).astype(np.int64)
        return (data, first, last, ends) if with_last else counts

    def _pieces(self, text: str, most: int = 1 << 20) -> list[str | int]:
        """The text cut at special strings (their ids stand there) and, where it is long, before single spaces that surely start a pretoken."""
        found: list[str | int] = [text]
        for string, number in self.special.items():
            if string in text:
                found = [y for x in found for y in ([x] if isinstance(x, int) else [z for part in x.split(string) for z in (number, part)][1:])]
        if len(text) <= most:
            return found
        out: list[str | int] = []
        for x in found:
            while isinstance(x, str) and len(x) > most:
                i = most
                while (i := x.rfind(" ", 1, i)) > 0 and self.kinds[ord(x[i - 1])] in (SPACE, WHITE):
                    pass
                if i <= 0:
                    i = most
                    while (i := x.find(" ", i + 1)) > 0 and self.kinds[ord(x[i - 1])] in (SPACE, WHITE):
                        pass
                    if i < 0:
                        break
                out.append(x[:i])
                x = x[i:]
            out.append(x)
        return out

    def _groups(self, texts: list[str]):
        """Pieces in order, in runs of bounded size, with the text that each belongs to."""
        held: list[str] = []
        owner: list[int] = []
        n = 0
        for i, text in enumerate(texts):
            for x in self._pieces(text or ""):
                if isinstance(x, int):
                    if held:
                        yield owner, None, held
                        held, owner, n = [], [], 0
                    yield [i], x, None
                    continue
                held.append(x)
                owner.append(i)
                n += len(x)
                if n >= 1 << 19:
                    yield owner, None, held
                    held, owner, n = [], [], 0
        if held:
            yield owner, None, held

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of tokens of each text: the sum of the counts that the transitions carry."""
        out = np.zeros(len(texts), np.int64)
        for owner, special, held in self._groups(texts):
            if held is None:
                out[owner] += 1
                continue
            np.add.at(out, owner, self._run(held, False))
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        ids: list[np.ndarray] = []
        out = np.zeros(len(texts), np.int64)
        for owner, special, held in self._groups(texts):
            if held is None:
                ids.append(np.array([special], np.int32))
                out[owner] += 1
                continue
            data, first, last, ends = self._run(held, True)
            first[ends] = True
            places = np.flatnonzero(first)
            body = np.ones(len(places) - 1, bool)
            body[np.searchsorted(places, ends)] = False
            begin, at = places[:-1][body], places[1:][body]
            mark = np.zeros(len(data), bool)
            while len(at):
                mark[at - 1] = True
                at = at - self.token_len[last[at - 1]]
                more = at > begin
                begin, at = begin[more], at[more]
            before = np.concatenate([[0], np.cumsum(mark)])[ends]
            ids.append(last[mark])
            np.add.at(out, owner, np.diff(np.concatenate([[0], before])))
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), out


_LOADED: dict[str, FstTokenizer] = {}


def load(path: str) -> FstTokenizer:
    """One transducer for each file and process, kept between tasks."""
    if path not in _LOADED:
        _LOADED[path] = FstTokenizer(path)
    return _LOADED[path]
