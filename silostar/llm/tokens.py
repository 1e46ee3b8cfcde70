"""Token counts and ids by the tokenizers library, a distinct word at a time.

Both vocabularies cut a text at white space before anything else, so that a text's tokens are
those of its words. Each Python worker keeps the words it has met (bounded), and the library
sees each of them once instead of every time it occurs.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct

# Words a worker keeps before it starts anew.
MAX_WORDS = 1_000_000
# Bytes of words and their ids likewise: texts without white space are words of any length.
MAX_BYTES = 64 << 20


@functools.cache
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def file_digest(path: str) -> str:
    """Names a tokenizer version by the content of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


# What the byte-level splitter may be cut around: printable ASCII and Latin letters.
_OTHER = re.compile("[^\n -~À-ɏ]")


class ByteLevelCounts:
    """Counts tokens of a byte-level vocabulary that splits words with their leading space.

    Between two visible characters, a single space starts a new word and a single line end
    is a word of its own; whatever follows is independent of what came before. Texts with
    other white space, doubled white space or other scripts are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer, self.known = load(path), {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def plain(text: str) -> bool:
        return not (
            not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text
            or " \n" in text or "\n " in text or _OTHER.search(text)
        )

    def __call__(self, texts: list[str]) -> list[int]:
        # A piece is a word with its leading space left out, or a line end with its word.
        split = [("\n" + t).replace("\n", " \n").split(" ")[1:] if self.plain(t) else None for t in texts]
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        known = self.known
        new = list({p for pieces in split if pieces for p in pieces if p not in known})
        known.update(zip(new, self.whole([p if p[0] == "\n" else " " + p for p in new])))
        rest = iter(self.whole([t for t, pieces in zip(texts, split) if pieces is None]))
        if "\n" not in known:
            known["\n"] = self.whole(["\n"])[0]
        line_end = known["\n"]
        return [
            next(rest) if pieces is None else sum(map(known.__getitem__, pieces)) - line_end
            for pieces in split
        ]


# Latin letters that are one character composed or not, and in lower case too.
_LATIN = [c for c in map(chr, range(0xC0, 0x100)) if c.isalpha()]
# How the splitter of the word vocabulary cuts a lower-case word of ASCII and these letters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_PRINTABLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordLevelIds:
    """Ids (little-endian unsigned 32-bit) of a vocabulary that drops white space.

    Words of printable ASCII and Latin letters without markup are lower-cased and cut as the
    tokenizer's own splitter does, and its model encodes the parts, in the characters that it
    has for bytes; all other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer, self.known, self.parts, self.held = load(path), {}, {}, 0
        self.model = self.tokenizer.model
        from tokenizers.pre_tokenizers import ByteLevel

        bytes_ = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {ord(c): bytes_.pre_tokenize_str(c)[0][0] for c in _LATIN}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            plain = part if part.isascii() else part.translate(self.bytes)
            found = self.parts[part] = _packed([t.id for t in self.model.tokenize(plain)])
        return found

    def _learn(self, words: list[bytes]) -> None:
        rest = []
        for word in words:
            if word.isalpha():  # ASCII letters alone: one part
                self.known[word] = self._part(word.lower().decode())
                continue
            text = word.decode()
            if _PRINTABLE.fullmatch(text) and "<|" not in text:
                self.known[word] = b"".join(map(self._part, _PARTS.findall(text.lower())))
            else:
                rest.append((word, text))
        encoded = self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False)
        self.known.update((w, _packed(e.ids)) for (w, _), e in zip(rest, encoded))
        self.held += sum(len(w) + len(self.known[w]) for w in words)

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [t.encode().split() for t in texts]
        known = self.known
        if len(known) + len(self.parts) > MAX_WORDS or self.held > MAX_BYTES:
            # Before new words are told from known ones: a batch needs the ids of both.
            known.clear()
            self.parts.clear()
            self.held = 0
        self._learn(list(set().union(*split).difference(known)))
        return [b"".join(map(known.__getitem__, words)) for words in split]
