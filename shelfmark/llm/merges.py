"""Byte-pair merges as a bounded-lookahead transducer, and the decoder's state machine.

Merging takes the pair of lowest rank first, the leftmost of equals. Whether
two neighbours join can depend on symbols to the right, but only so far:
`lookahead` derives from the merge list how many symbols right of a token's end
can still matter. Tokens that end at least so far before the end of what has
been read are final, whatever follows, so they are emitted and forgotten; a
boundary that no merge crosses parts the text into two that merge alike alone.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import regex

END = "</w>"
#: Characters that are white space to the vocabulary; narrower than str.isspace by U+001C-U+001F.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPACES = regex.compile(f"[{SPACE}]+")
_NARROW = regex.compile("[\x1c-\x1f]")
#: Fixed by the vocabulary file.
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")


def _unsettled(char: str) -> bool:
    """Whether Unicode tables of other ages may differ: unknown to Python, or a combining mark younger than Unicode 3.2."""
    if unicodedata.combining(char):
        return unicodedata.ucd_3_2_0.category(char) == "Cn"
    return unicodedata.category(char) == "Cn"


def _one_of(limit: int, more: str = "") -> re.Pattern:
    """One unsettled character below `limit`, or one of `more`."""
    found = [_unsettled(chr(c)) for c in range(limit)] + [False]
    starts = [c for c in range(limit) if found[c] and not (c and found[c - 1])]
    ends = [c for c in range(limit) if found[c] and not found[c + 1]]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + more + "]")


#: The first is fast and takes all beyond the basic plane for unsettled; the second is exact.
_SUSPECT = _one_of(0x10000, "\U00010000-\U0010ffff")
_UNSETTLED = _one_of(sys.maxunicode + 1)


def unsettled(text: str) -> bool:
    return not text.isascii() and _SUSPECT.search(text) is not None and _UNSETTLED.search(text) is not None


#: Longer chunks and words are not remembered, so the memory is bounded in bytes.
REMEMBERED_LETTERS = 256


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class Merges:
    """A merge list with its vocabulary, ready to be run over a stream of symbols."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.ids = vocab
        self.rank = {pair: rank for rank, pair in reversed(list(enumerate(merges)))}
        self.lookahead = self._lookahead(merges)
        self.window = 4 * self.lookahead + 64

    @staticmethod
    def _symbols(token: str) -> int:
        return len(token.removesuffix(END))

    def _lookahead(self, merges: list[tuple[str, str]]) -> int:
        """Symbols right of a token's end that can decide whether the token is made or taken up.

        Merges are taken in their order, so everything a merge can depend on is
        known: `made[t]` is how far right of t's end its making looks, and
        `taken[t]` how far an earlier merge of t with a right neighbour looks.
        """
        made: dict[str, int] = {}
        taken: dict[str, int] = {}
        most = 0
        for left, right in merges:
            whole, size = left + right, self._symbols(right)
            far = max(made.get(right, 0), taken.get(right, 0), made.get(left, 0) - size, 0)
            made[whole] = max(made.get(whole, 0), far)
            taken[left] = max(taken.get(left, 0), size + far)
            most = max(most, taken[left], far)
        return most

    def merge(self, symbols: list[str]) -> list[str]:
        """All merges of a short run of symbols."""
        get, none = self.rank.get, len(self.rank)
        parts = list(symbols)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return parts

    def tokens(self, symbols: list[str]) -> list[str]:
        """Tokens of a word whose symbols are at hand; below the window the transducer would hold all of them."""
        return self.merge(symbols) if len(symbols) < self.window else list(self.transduce(symbols))

    def transduce(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of a stream of symbols, each as soon as no later symbol can change it.

        The last symbol of the stream carries the end mark. At most `window`
        symbols and their tokens are held.
        """
        held: list[str] = []
        for symbol in symbols:
            held.append(symbol)
            if len(held) >= self.window:
                end, cut = 0, len(held) - self.lookahead
                for token in self.merge(held):
                    size = self._symbols(token)
                    if end + size > cut:
                        break
                    yield token
                    end += size
                held = held[end:]
        yield from self.merge(held)


class Decoder:
    """Ids to text one at a time: the text is the tokens' own strings, parted by blanks."""

    def __init__(self, tokens: dict[int, str]):
        self.tokens = tokens
        self.begun = False

    def push(self, token_id: int) -> str:
        """What `token_id` adds to the text; an unknown id adds nothing."""
        token = self.tokens.get(token_id)
        if token is None:
            return ""
        lead = " " if self.begun else ""
        self.begun = True
        return lead + token


class PlainDecoder:
    """Ids to readable text: bytes are joined to characters as they complete, ends of words are blanks."""

    def __init__(self, tokens: dict[int, str]):
        import codecs

        self.tokens = tokens
        self.bytes = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, token_id: int, final: bool = False) -> str:
        token = self.tokens.get(token_id, "")
        word_ends = token.endswith(END)
        raw = bytes(self.bytes[c] for c in token.removesuffix(END) if c in self.bytes)
        return self.state.decode(raw, final or word_ends) + (" " if word_ends else "")


class Memory(dict):
    """A dictionary of at most two generations of `size` entries; the older one is forgotten whole."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.older = size, {}

    def recall(self, key):
        """The entry of an earlier generation, brought forward, or None."""
        value = self.older.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value):
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value


class WordCodec:
    """Text to ids and back for the word vocabulary, as its file prescribes.

    Special tokens in a text are cut out first; each piece between them is
    composed (NFC), lower-cased letter by letter, parted at white space and
    into words; a word's bytes are the symbols that merge. Since nothing
    crosses white space, what lies between is encoded once while it is
    remembered; the memory is bounded. Where a text has code points
    on which Unicode tables of different ages may differ, the library's own
    normaliser and word boundaries are asked.
    """

    def __init__(self, path: str, memory: int = 300_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.merges = Merges(spec["model"]["vocab"], [tuple(m) for m in spec["model"]["merges"]])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (spec["model"]["vocab"] | self.special).items()}
        self.letters = byte_letters()
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._chunks = self._words = Memory(memory)  # one memory for both
        self._path, self._library = path, None
        self._bytes = {letter: byte for byte, letter in enumerate(self.letters)}
        self._shown = dict(enumerate(self.letters))

    def _stages(self):
        """The library's tokenizer, for its normaliser and word boundaries; read when first needed."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        return self._library

    def _composed(self, piece: str) -> list[str]:
        """What lies between white space in a piece, composed and lower-cased."""
        if piece.isascii():
            plain = piece.lower()
        elif unsettled(piece):
            plain = self._stages().normalizer.normalize_str(piece)
        else:
            plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        return plain.split() if not _NARROW.search(plain) else [c for c in _SPACES.split(plain) if c]

    def _parted(self, chunk: str) -> list[str]:
        """Words of a chunk; letters alone, all known to Python, are one."""
        if chunk.isalpha():
            return [chunk]
        if not unsettled(chunk):
            return _WORD.findall(chunk)
        spelled = self._stages().pre_tokenizer.pre_tokenize_str(chunk)
        return [bytes(self._bytes[c] for c in word).decode("utf-8") for word, _ in spelled]

    def _word(self, word: str) -> tuple[int, str, str]:
        """(number of ids, ids as text, decoded text) of one word; a symbol that the vocabulary lacks gives none."""
        found = self._chunks.get(word) or self._chunks.recall(word)
        if found is None:
            letters = list(word.encode("utf-8").decode("latin-1").translate(self._shown))
            letters[-1] += END
            known = self.merges.ids
            ids = [known[t] for t in self.merges.tokens(letters) if t in known]
            found = (len(ids), " ".join(map(str, ids)), self.decode(ids))
            if len(word) <= REMEMBERED_LETTERS:
                self._chunks.keep(word, found)
        return found

    def _chunk(self, chunk: str) -> tuple[int, str, str]:
        """The same of all words of what lies between white space; a word alone is parted into itself, so one memory serves both."""
        found = self._chunks.recall(chunk)
        if found is None:
            parted = self._parted(chunk)
            if parted == [chunk]:
                return self._word(chunk)
            words = [word for word in map(self._word, parted) if word[0]]
            found = (sum(w[0] for w in words), " ".join([w[1] for w in words]), " ".join([w[2] for w in words]))
            if len(chunk) <= REMEMBERED_LETTERS:
                self._chunks.keep(chunk, found)
        return found

    def decode(self, ids: Iterable[int]) -> str:
        decoder = Decoder(self.tokens)
        return "".join(map(decoder.push, ids))

    def entries(self, text: str) -> list[tuple[int, str, str]]:
        """(number of ids, ids as text, decoded text) of each chunk and special token of a text, in order."""
        out = []
        for i, piece in enumerate(self._special.split(text) if "<|" in text else (text,)):
            if i % 2:
                out.append((1, str(self.special[piece]), piece))
                continue
            chunks = self._composed(piece)
            found = list(map(self._chunks.get, chunks))
            if None in found:
                found = [e or self._chunks.get(c) or self._chunk(c) for e, c in zip(found, chunks)]
            out += found
        return [entry for entry in out if entry[0]]

    def encode(self, text: str) -> list[int]:
        return [int(i) for entry in self.entries(text) for i in entry[1].split()]
