"""Token ids of whole texts, by the files of public tokenizers.

The tokenizers split a text into pieces before they look at their merges, and no piece crosses the borders
that the two patterns below draw.  So a text's ids are those of its parts in a row, and every part that
comes again is looked up instead of encoded again.  Added tokens of the file (``<|endoftext|>``) that a text spells
out are cut out before that and give their own ids, as the library does by default.

A run of plain letters is a part of its own, without the punctuation after it: fewer parts are new that way, and such a
part is one piece, which goes to the tokenizer's merges without its regular expressions.
"""

from __future__ import annotations

import os
import re
import struct

from tenderloom.llm.common import kept_in_worker, slices

# Unicode's White_Space, as the tokenizers' regular expressions know it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters of Latin-1, none of which joins with its neighbours, and a run of them up to white space or ASCII punctuation.  An
# apostrophe is none: pieces like "'s" begin with it.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = rf"[{LETTERS}]++(?![^{SPACE}!-&(-/:-@\[-`{{-~])"
# Byte-level vocabularies keep white space: a space belongs to the word after it.
WITH_SPACES = f" ?{PLAIN}| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
# Word-level vocabularies drop it.
WORDS_ONLY = f"{PLAIN}|[^{SPACE}]+"

MAX_PART = 64
MAX_CACHE = 300_000


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _letters() -> str:
    return "".join(re.findall(f"[{LETTERS}]", "".join(map(chr, range(256)))))


class _Known(dict):
    """Ids by part; a part that is asked for the first time is learnt."""

    def __init__(self, encoder: Encoder, given: dict[str, bytes]):
        super().__init__(given)
        self.encoder, self.long = encoder, []

    def __missing__(self, part: str) -> bytes:
        ids = self[part] = self.encoder.learn(part)
        if len(part) > MAX_PART:
            self.long.append(part)
        return ids


class Encoder:
    """``encode(texts)``: each text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.parts = re.compile(pattern).findall
        tokens = self.model.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in tokens.values()):
            raise ValueError(f"{path}: added tokens must stand for their plain text")
        self.added = {t.content: k.to_bytes(4, "little") for k, t in tokens.items()}
        # The library takes the leftmost of them, and the longest of those.
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})").split
        # What the tokenizer makes of each character of plain words before its merges, if it keeps such words whole.
        seen = {c: self._pieces(f"{c}a") for c in f" {_letters()}"}
        whole = all(len(pieces) == 1 for pieces in seen.values())
        self.plain = re.compile(f" ?[{LETTERS}]+" if whole else "(?!)").fullmatch
        self.seen = {ord(c): pieces[0].removesuffix(seen["a"][0][1:]) for c, pieces in seen.items() if whole}
        # Two generations: when the young one is full, the old one goes, and parts that come again move back.
        self.young = _Known(self, self.added)
        self.old: dict[str, bytes] = {}

    def _parts(self, text: str) -> list[str]:
        if not any(token in text for token in self.added):
            return self.parts(text)
        cut = self.cut(text)
        return [p for k, piece in enumerate(cut) for p in ([piece] if k % 2 else self.parts(piece))]

    def _pieces(self, text: str) -> list[str]:
        """What the merges are applied to, one by one."""
        normalizer, splitter = self.model.normalizer, self.model.pre_tokenizer
        text = normalizer.normalize_str(text) if normalizer else text
        return [piece for piece, _ in splitter.pre_tokenize_str(text)] if splitter else []

    def learn(self, part: str) -> bytes:
        if part in self.old:
            return self.old[part]
        if self.plain(part):
            ids = [t.id for t in self.model.model.tokenize(part.translate(self.seen))]
        else:
            ids = self.model.encode_batch_fast([part], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _slice(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > MAX_CACHE:
            self.young, self.old = _Known(self, self.added), self.young
        known = self.young
        known.long.clear()
        out = [b"".join(map(known.__getitem__, self._parts(text))) for text in texts]
        for p in known.long:
            del known[p]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for first, last in slices(texts):
            out += self._slice(texts[first:last])
        return out


def encoder(path: str, pattern: str) -> Encoder:
    return kept_in_worker(f"encoder {path} {pattern}", lambda: Encoder(path, pattern))
