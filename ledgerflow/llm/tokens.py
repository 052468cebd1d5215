"""Token ids of whole texts, with the tokenizers library.

The same words come up again and again, so a text is cut at single blanks, where no token
of the tokenizers used here can reach across.  Pieces met for the first time are encoded
together, without the signs that end them, for letters (of the normalised text) and these
never share a token either; their ids are kept, up to a fixed number of pieces per Python
worker.  Texts that hold ``<|``, with which a special token may begin, are encoded as they
are; texts are taken in slices, a very long one in a slice of its own.

Most texts are plain (:func:`is_plain`): of Latin-1, with single blanks and line feeds and
no two signs in a row.  These are cut at their line feeds, full stops and commas too, so that
nearly all pieces are words.  Words of letters alone go to the tokenizer's model many at a
time, as one line, whose ids are told apart by the sign that the vocabulary gives to the
beginning or the end of a word.  Both are done only if the tokenizer proves to be such a one.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Sequence

import numpy as np

from ledgerflow.llm.common import worker_cache

KEPT_PIECES = 300_000  # per generation; there are two
LONG_PIECE = 64  # longer pieces are not kept
SLICE_CHARS = 2 << 20
SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
# all white space but the blank and the line feed
RARE_BLANKS = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B)))
# a mark that a piece of a plain text does not follow a blank
GLUED = "\x01"
# classes of the bytes of Latin-1: blanks, letters and digits, other signs, control characters
CLASS_OF = bytes(
    b if b in b" \n" else ord("a") if chr(b).isalnum() else 0 if b < 0x20 or 0x7F <= b < 0xA1 else ord("!")
    for b in range(256))
LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]{1,%d}" % LONG_PIECE)
PROBE = ["the", "Thesen", "andreerening", "Z\xfcrich", "\xe9iereuxre", "\xc0\xd6\xdf", "a", "Q", "\xff", "Anteil", "CamelCase"]
LINE_WORDS = 512
# how vocabularies of bytes write the blank and the bytes 0x7F to 0xA0 and 0xAD
BLANK_SIGN = "\u0120"
SIGN_OF = {b: chr(0x121 + k) for k, b in enumerate(range(0x7F, 0xA1))} | {0xAD: "\u0143"}
# signs that a word's letters and digits share no token with
TAIL = ".,;:!?#$%&*|"


def blanks_stand_alone(text: str) -> bool:
    """Whether no blank of a text touches other white space or an end of the text."""
    return not (
        "  " in text or " \n" in text or "\n " in text or text.startswith(" ") or text.endswith(" ")
        or any(map(text.__contains__, RARE_BLANKS))
    )


def is_plain(text: str) -> bool:
    """Whether a text is of Latin-1, with single blanks and line feeds and no signs in a row."""
    try:
        classes = text.encode("latin-1").translate(CLASS_OF)
    except UnicodeEncodeError:
        return False
    if b"!!" in classes or b"\0" in classes or b"  " in classes or b"\n\n" in classes:
        return False
    alone = not (text.startswith(" ") or text.endswith(" ") or " \n" in text or "\n " in text)
    return alone and " ." not in text and " ," not in text


def id_bytes(ids: Sequence[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    packed = array("I", ids)
    if packed.itemsize != 4:
        raise OverflowError("unsigned int is not 32 bits wide here")
    return packed.tobytes()


class Encoder:
    """Encodes texts to the bytes of their ids.

    Two generations of pieces are kept: when the young one is full it becomes the old one,
    and pieces that are still in use come back from there.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        normalizer = self.tokenizer.normalizer
        # capitals of ASCII words make no difference to this tokenizer
        self.lowers = normalizer is not None and normalizer.normalize_str("AZ") == "az"
        self.normal = normalizer.normalize_str if normalizer is not None else str
        alone = lambda *parts: b"".join(self.whole(list(parts)))
        # whether blanks leave no trace, and whether a piece is what it is behind any other one
        self.blankless = alone("a b\nc") == alone("a", "b", "c") == alone(" a", " b", "\nc")
        self.cuts = alone("Ab, c.\nD e") == alone("Ab", ",", " c", ".", "\n", "D", " e")
        self.line = self.line_encoder()

    def line_encoder(self):
        """A function from words of letters, each behind a blank, to their ids, or None.

        It passes over the rules that cut a text into words, which are cut already.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        lines = Tokenizer(self.tokenizer.model)  # one model for both
        lines.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        # letters of Latin-1 as the signs of their bytes in vocabularies of bytes
        signs = {chr(c): "".join(SIGN_OF.get(b, chr(b)) for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        table = str.maketrans(signs)
        vocabulary = self.tokenizer.get_vocab()
        size = 1 + max(vocabulary.values(), default=0)
        begins, ends = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        for token, number in vocabulary.items():
            begins[number], ends[number] = token.startswith(BLANK_SIGN), token.endswith("</w>")

        def line(words: list[str]) -> list[bytes] | None:
            text = " ".join(words)
            if self.lowers:
                text = text.lower()
            if not text.isascii():
                text = text.translate(table)
            if not self.blankless:
                text = BLANK_SIGN + text.replace(" ", f" {BLANK_SIGN}")
            (found,) = lines.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4")
            if self.blankless:
                until = np.flatnonzero(ends[ids]) + 1
            else:
                until = np.append(np.flatnonzero(begins[ids])[1:], len(ids))
            if len(until) != len(words):
                return None
            raw, until = ids.tobytes(), (4 * until).tolist()
            return [raw[b:e] for b, e in zip([0, *until], until)]

        def encode(words: list[str]) -> list[bytes]:
            out = []
            for low in range(0, len(words), LINE_WORDS):
                some = words[low : low + LINE_WORDS]
                out.extend(line(some) or self.whole([" " + word for word in some]))
            return out

        right = self.whole([" " + word for word in PROBE])
        # the second time each word alone, so that each one's own ids are held against the others'
        return encode if line(PROBE) == right == [b"".join(line([w]) or [b"?"]) for w in PROBE] else None

    def plain_pieces(self, text: str) -> list[str]:
        """The pieces of a plain text, all of them behind a blank or with a mark that they are not."""
        if self.blankless:
            if self.lowers:
                text = text.lower()
            return text.replace(".", " . ").replace(",", " , ").split()
        text = text.replace(".", f" {GLUED}.").replace(",", f" {GLUED},").replace("\n", f" {GLUED}\n {GLUED}")
        return (GLUED + text).split(" ")

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as they are, without any piece."""
        return [id_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def look_up(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of pieces, each of which follows a blank; those that are long are not kept."""
        if len(self.young) > KEPT_PIECES:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        fresh = []
        for piece in wanted.difference(young):
            if piece in old:
                young[piece] = old[piece]
            else:
                fresh.append(piece)
        if self.line is not None:
            # those of ASCII, which are the signs of their bytes already, stand together
            words = sorted(filter(LETTERS.fullmatch, fresh), key=str.isascii)
            young.update(zip(words, self.line(words)))
            fresh = [piece for piece in fresh if piece not in young]
        made = self.encode_pieces(fresh) if fresh else {}
        young.update((p, ids) for p, ids in made.items() if len(p) <= LONG_PIECE)
        long = {p: ids for p, ids in made.items() if len(p) > LONG_PIECE}
        return Both(young, long) if long else young

    def ends_in_letter(self, stem: str) -> bool:
        """Whether a stem ends in a letter or digit as the tokenizer sees it.

        Its lower-casing may turn a letter into one with a mark behind it, and a mark can
        share a token with the signs that follow.
        """
        last = stem[-1:]
        return last.isalnum() and (last.isascii() or self.normal(last)[-1:].isalnum())

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces that follow a blank or are marked, by way of their stems."""
        found: dict[str, bytes] = {}
        glued = [piece for piece in pieces if piece.startswith(GLUED)]
        if glued:
            found.update(zip(glued, self.whole([piece[1:] for piece in glued])))
            pieces = [piece for piece in pieces if not piece.startswith(GLUED)]
        cut, stems, tails = [], {}, set()
        for piece in pieces:
            stem = piece.rstrip(TAIL)
            if self.ends_in_letter(stem):
                tail = piece[len(stem):]
            else:
                stem, tail = piece, ""
            if self.lowers and stem.isascii():
                stem = stem.lower()
            if tail not in self.tails:
                tails.add(tail)
            if stem not in stems:
                stems[stem] = self.young.get(stem) or self.old.get(stem)
            cut.append((stem, tail))
        fresh = [stem for stem, known in stems.items() if known is None]
        stems.update(zip(fresh, self.whole([" " + stem for stem in fresh])))
        # a stem is a piece like any other
        self.young.update((stem, ids) for stem, ids in stems.items() if len(stem) <= LONG_PIECE)
        if tails:
            if len(self.tails) > LONG_PIECE * 100:
                self.tails = {"": b""}
                tails.update(tail for _, tail in cut)
            ends = sorted(tails - {""})
            self.tails.update(zip(ends, self.whole(ends)))
        found.update((piece, stems[stem] + self.tails[tail]) for piece, (stem, tail) in zip(pieces, cut))
        return found

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of whole texts; a null counts as empty."""
        out: list[bytes] = []
        low = 0
        while low < len(texts):
            size, high = 0, low
            while high < len(texts) and (size < SLICE_CHARS or high == low):
                size += len(texts[high] or "")
                high += 1
            out.extend(self._encode(texts[low:high]))
            low = high
        return out

    def _encode(self, texts: Sequence[str | None]) -> list[bytes]:
        begins: list[str] = []  # what is encoded as it is: whole texts, and the first pieces of others
        cut: list[list[str]] = []
        plain = []
        for text in texts:
            plain.append(False)
            if not text or "<|" in text or GLUED in text:  # empty, or with what may be a special token
                begins.append(text or "")
                cut.append([])
            elif self.cuts and is_plain(text):
                plain[-1] = True
                cut.append(self.plain_pieces(text))
            else:
                first, *parts = text.split(" ") if blanks_stand_alone(text) else SINGLE_BLANK.split(text)
                begins.append(first)
                cut.append(parts)
        ids = self.look_up(set().union(*cut))
        whole = iter(self.whole(begins))
        return [
            (b"" if own else next(whole)) + b"".join(map(ids.__getitem__, parts)) for own, parts in zip(plain, cut)
        ]


class Both:
    """Two dictionaries read as one."""

    def __init__(self, many: dict, few: dict):
        self.many, self.few = many, few

    def __getitem__(self, key):
        return self.many[key] if key in self.many else self.few[key]


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for a tokenizer file."""
    kept = worker_cache("encoders")
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
