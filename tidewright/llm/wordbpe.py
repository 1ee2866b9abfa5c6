"""Ids of whole texts by a public tokenizer, each distinct piece of a batch encoded once.

A vocabulary whose rules drop white space and encode each piece of the rest by itself gives a text
the ids of its pieces, end to end. Texts of printable ASCII, blanks, line feeds and Latin-1 letters
are cut into pieces here, all texts of a batch at once, and the distinct pieces go through a quicker
library from the ranks of the same vocabulary, so a piece costs the same whether or not it came
before and nothing is held from batch to batch. Of any other text so do the words of that kind, and
its other words go through the whole library tokenizer, as does every text that holds the string of
an added token or where the vocabulary has other rules.
"""
from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from .common import per_process, ranges
from .crosstokens import _byte_letters

# The splitting rule this shortcut is for, and the texts it is taken for.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = r"[\x20-\x7e\nÀ-ÖØ-öø-ÿ]*"
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
           {"type": "Lowercase"}]
# Fixed values, for UTF-8 bytes of plain texts: small letters, and what a byte belongs to. NUL ends a
# text, or a piece on its way to the library; ODD stands for a word that is not plain.
_ODD = "\x01"
_BLANK, _LETTER, _DIGIT, _OTHER = range(4)
_SMALL = bytes(b + 32 if 0x80 <= b <= 0x9E else ord(chr(b).lower()) if b < 128 else b for b in range(256))
_CLASS = bytes(_BLANK if b in b"\0 \n" else _LETTER if b >= 128 or chr(b).islower() else
               _DIGIT if chr(b).isdigit() else _OTHER for b in range(256))


def _ranks(rules: dict, added: list[str]) -> dict[bytes, int] | None:
    """The ids of tokens by their bytes, the end of a word being NUL. None where these ids do not
    say in which order pairs merge: first a word's last byte with its end, then as the ids rise."""
    letters, model = _byte_letters(), rules["model"]
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    if not all(c in letters and c + "</w>" in vocab and c in vocab for c in letters):
        return None
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    ends = max(vocab[c + "</w>"] for c in letters)
    if len(made) + 2 * len(letters) != len(vocab) or None in made \
            or any(b <= a for a, b in zip([ends, *made], made)):
        return None
    ranks = {bytes(map(letters.__getitem__, t.removesuffix("</w>"))) + b"\0" * t.endswith("</w>"): i
             for t, i in vocab.items()}
    return ranks if len(ranks) == len(vocab) else None


def _pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces of plain texts end to end, where each begins and the last one ends,
    and the number of the first piece of each text and of one after the last."""
    data = ("\0".join(texts) + "\0").encode().translate(_SMALL)
    held, kind = np.frombuffer(data, np.uint8), np.frombuffer(data.translate(_CLASS), np.uint8)
    first = np.ones(len(held), bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | (held[1:] == ord(_ODD))
    quote = np.flatnonzero(held == ord("'"))
    if len(quote):  # 's and the like, where the apostrophe is the first of its run
        quote = quote[(kind[np.maximum(quote, 1) - 1] != _OTHER) | (quote == 0)]
        after = np.concatenate([held, np.zeros(2, np.uint8)])
        one, two = after[quote + 1], after[quote + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
                | (one == ord("l")) & (two == ord("l")))
        first[quote[short | long] + 1] = False
        first[quote[short] + 2] = first[quote[long] + 3] = True
    kept = kind != _BLANK
    starts = np.flatnonzero(first & kept)
    ends = np.flatnonzero(held == 0)
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    return held[kept], np.append(np.flatnonzero(first[kept]), np.count_nonzero(kept)), bounds


class WordEncoder:
    """Holds the ids of at most ``most`` words that are not plain and starts afresh when full."""

    def __init__(self, vocabulary: bytes, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_buffer(vocabulary)
        rules = json.loads(vocabulary)
        added = rules.get("added_tokens") or []
        self.added = [token["content"] for token in added]
        self.size = self.whole.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        first = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_word = ((first.get("pattern") or {}).get("Regex") == _SPLIT
                        and (rules.get("normalizer") or {}).get("normalizers") == _NORMAL
                        and rules["model"].get("end_of_word_suffix") == "</w>"
                        and not any(token["normalized"] for token in added))
        ranks = _ranks(rules, self.added) if self.by_word else None
        self.by_word = ranks is not None
        if self.by_word:
            self.quick = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks,
                                           special_tokens={}).encode_to_numpy
            self.last = np.zeros(self.size, bool)
            self.last[[i for t, i in ranks.items() if t[-1:] == b"\0" and t != b"\0"]] = True
        self.plain = re.compile(_PLAIN).fullmatch
        self.known, self.most = {}, most

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes()
                for e in self.whole.encode_batch(texts, add_special_tokens=False)]

    def _mixed(self, text: str, odd: list[str]) -> str:
        """A text that is not plain with ``_ODD`` for its words that are not, which go to ``odd``."""
        words = text.replace("\n", " ").split(" ")
        for i, word in enumerate(words):
            if not self.plain(word):
                odd.append(word)
                words[i] = _ODD
        return " ".join(words)

    def _distinct(self, held: np.ndarray, starts: np.ndarray):
        """For each piece the number of its text among the distinct ones; their ids end to end, and
        where those of each begin and the last ones end."""
        whole = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1,
                                      [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(held)])
        coded = whole.dictionary_encode()
        _, at, data = coded.dictionary.buffers()
        at = np.frombuffer(at, np.int64, len(coded.dictionary) + 1)
        ended = np.zeros(int(at[-1]) + len(at) - 1, np.uint8)
        inside = np.ones(len(ended), bool)
        inside[at[1:] + np.arange(len(at) - 1)] = False
        ended[inside] = np.frombuffer(data, np.uint8, int(at[-1]))
        ids = self.quick(ended.tobytes().decode())
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(at) - 1:
            raise ValueError("a piece has not one end")
        return coded.indices.to_numpy(), ids.astype(self.kind), np.concatenate([[0], ends])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian numbers of type ``kind``."""
        if not self.by_word:
            return self._whole(texts)
        whole = [i for i, t in enumerate(texts) if any(token in t for token in self.added)]
        kept, odd = set(whole), []
        held, starts, bounds = _pieces(["" if i in kept else t if self.plain(t) else self._mixed(t, odd)
                                        for i, t in enumerate(texts)])
        out = [b""] * len(texts)
        if len(starts) > 1:
            code, ids, ends = self._distinct(held, starts)
            if odd:
                if len(self.known) > self.most:
                    self.known = {}
                new = list(set(odd).difference(self.known))
                self.known.update(zip(new, self._whole(new)))
                place = {word: len(ends) - 1 + i for i, word in enumerate(dict.fromkeys(odd))}
                code = code.copy()
                code[held[starts[:-1]] == ord(_ODD)] = [place[word] for word in odd]
                found = [np.frombuffer(self.known[word], self.kind) for word in place]
                ids = np.concatenate([ids, *found])
                ends = np.concatenate([ends, ends[-1] + np.cumsum([len(x) for x in found])])
            size = np.diff(ends)[code]
            held = ids[ranges(ends[code], size)].tobytes()
            cuts = np.concatenate([[0], np.cumsum(size)])[bounds] * self.kind.itemsize
            out = [held[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
        for i, found in zip(whole, self._whole([texts[i] for i in whole]) if whole else ()):
            out[i] = found
        return out


def encoder(vocabulary: bytes, most: int = 1_000_000) -> WordEncoder:
    """The worker's own encoder, with the ids of at most about ``most`` words that are not plain."""
    return per_process(("words", hash(vocabulary), most), lambda: WordEncoder(vocabulary, most))
