"""Pre-tokens of a ``tokenizers`` file, cut as the library cuts them, at regex speed.

The library splits a text on its special strings, normalises each piece and cuts it into
pre-tokens, between which no merge happens. Below ``FAST`` code points the normaliser only
lower-cases single characters, so a plain regular expression finds the same pre-tokens; its
character classes are read off the library once per worker. A piece with any other
character goes through the library's own normaliser and splitter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from tokenizers import Tokenizer

# Latin letters up to Extended-B: no combining marks, stable categories.
FAST = 0x250


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(0x100, 0x200))
    kept = set(plain)
    return [chr(b) if b in kept else chr(next(shifted)) for b in range(256)]


BYTE_CHARS = byte_alphabet()
_BYTE_OF = {c: b for b, c in enumerate(BYTE_CHARS)}


def to_byte_chars(word: str) -> str:
    """``word`` in the byte alphabet of the vocabulary."""
    return "".join([BYTE_CHARS[b] for b in word.encode("utf-8", "replace")])


def from_byte_chars(mapped: str) -> str:
    return bytes([_BYTE_OF[c] for c in mapped]).decode("utf-8")


class PreTokenizer:
    """Cuts texts for one tokenizer file (its JSON as bytes or text)."""

    def __init__(self, source: str | bytes):
        self.source = source.decode() if isinstance(source, bytes) else source
        self.library = Tokenizer.from_str(self.source)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        # The longest special string wins where several begin.
        cuts = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, cuts)) + ")") if cuts else None
        self._slow = re.compile(f"[^\\x00-{chr(FAST - 1)}]")
        self._pattern = self._fast_pattern()

    def _kind(self, c: str) -> str:
        """Class of one character, as the library's splitter treats it between letters and digits."""
        cut = [from_byte_chars(s) for s, _ in self.library.pre_tokenizer.pre_tokenize_str(f"a{c}{c}a")]
        if len(cut) == 1:
            return "letter"
        if c not in "".join(cut):
            return "space"
        return "digit" if len(cut) == 4 else "other"

    def _fast_pattern(self) -> re.Pattern:
        kinds: dict[str, str] = {"letter": "", "digit": "", "other": "", "space": ""}
        for code in range(FAST):
            c = chr(code)
            for low in self.library.normalizer.normalize_str(c) if not c.isspace() else c:
                if ord(low) < FAST and low not in kinds[kind := self._kind(low)]:
                    kinds[kind] += low
        letter, digit, other = (f"[{re.escape(kinds[k])}]" for k in ("letter", "digit", "other"))
        # Fixed value: the contractions of the vocabulary's splitter.
        return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{digit}|{other}+")

    def words(self, piece: str) -> list[str]:
        """Pre-tokens of a piece without special strings."""
        low = piece.lower()
        if self._slow.search(piece) is None and self._slow.search(low) is None:
            return self._pattern.findall(low)
        # Strings of a JVM are valid UTF-8; a lone surrogate can only come from Python callers.
        piece = piece.encode("utf-8", "replace").decode()
        normal = self.library.normalizer.normalize_str(piece)
        return [from_byte_chars(s) for s, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """``(special id, [])`` or ``(None, pre-tokens)`` in text order."""
        if self._special is None or self._special.search(text) is None:
            yield None, self.words(text)
            return
        for part in self._special.split(text):
            if part in self.special:
                yield self.special[part], []
            elif part:
                yield None, self.words(part)
