"""What a vocabulary file with a merge list and word ends makes of a text before it merges: special
strings, runs without white space, and the pieces of a run in byte symbols.

White space separates pieces and is dropped, so runs without it can be looked at one by one. The
library's own normaliser and splitter judge every run with a character beyond Latin-1 letters, since
their letter, number and lower-case tables are not Python's; within these there is nothing to differ on.
"""

from __future__ import annotations

import json

import regex
from tokenizers import Tokenizer


class Splitter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.ascii_piece = regex.compile(pattern, regex.ASCII)
        # The same for Latin-1 letters, each of which the library lowers and splits alike; its byte
        # symbols come from the library.
        letters = [chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha()]
        self.latin = regex.compile("[!-~" + "".join(letters) + "]+")
        self.latin_piece = regex.compile(pattern)
        self.latin_symbols = str.maketrans({
            c: "".join(p for p, _ in self.split(c)) for c in letters if c == c.lower()})
        self.gap = regex.compile(r"[\x20\x09-\x0D]+")
        self.separators = regex.compile("[\x1c-\x1f]")

    def parts(self, text: str | None) -> list[str]:
        """Plain text and special strings in turn, plain text first and last."""
        if not text:
            return []
        return self.special.split(text) if self.specials else [text]

    def runs(self, plain: str) -> list[str]:
        """Runs without white space. Python also splits at four separators that are none here."""
        return self.gap.split(plain) if self.separators.search(plain) else plain.split()

    def pieces(self, run: str) -> list[str]:
        """The pieces of a run, each a string of byte symbols."""
        if run.isascii():
            found = self.ascii_piece.findall(run.lower())
            # Control characters and blanks are the only ASCII bytes whose symbol is another one.
            if run.isprintable():
                return found
        elif self.latin.fullmatch(run):
            return [p.translate(self.latin_symbols) for p in self.latin_piece.findall(run.lower())]
        return [piece for piece, _ in self.split(self.normalise(run))]
