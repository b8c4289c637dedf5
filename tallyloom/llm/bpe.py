"""Token ids of whole texts, with each distinct word encoded once per worker."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyloom.llm import pieces
from tallyloom.llm.common import per_worker

#: Texts that are encoded as a whole: characters whose lower case depends on their neighbours or is two characters, one of
#: them a mark that the words next to it take up, and what may be a special token.
_WHOLE = "İ|Σ|<\\|"
#: A run of stops or commas between a Latin letter or digit and white space, where the pre-tokenizer cuts as well. Other
#: letters may be taken apart into a letter and a mark, and a mark takes up the stops after it.
_STOPS = r"([0-9A-Za-zÀ-ÖØ-öø-ſ])([.,]+)([ \n])"


class WordEncoder:
    """Encodes texts with a ``tokenizers`` file whose words never reach over a blank or a line end.

    That holds for vocabularies whose pre-tokenizer drops white space. A text is cut at blanks, line ends and
    before a run of stops or commas between a word and white space; each distinct piece is encoded by the library once,
    and the ids of a text are put together from those of its pieces. If the file lower-cases anyway, texts are lower-cased
    before, so that fewer pieces differ. Texts where that could matter are encoded as a whole (``_WHOLE``).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.codes = pieces.Ragged("<u4"), pieces.Codes(self._learn)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        found = self._encoded(new)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.ids.add(np.fromiter((i for ids in found for i in ids), "<u4", int(lengths.sum())), lengths)

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; none for a null text."""
        if len(self.codes.known) > pieces.KEPT_PIECES:
            self._forget()
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~whole))
        if self.lowers:
            plain = pc.utf8_lower(plain)
        cut = pc.split_pattern(pc.replace_substring(pc.replace_substring_regex(plain, _STOPS, r"\1 \2\3"), "\n", " "), " ")
        ids, lengths = self.ids.take(self.codes(cut.flatten()))
        per_text = pieces.sums(lengths, np.diff(cut.offsets.to_numpy()))
        ends, data = np.cumsum(per_text) * 4, ids.tobytes()
        out, own = [b""] * len(texts), np.flatnonzero(~whole)
        for i, end, n in zip(own.tolist(), ends.tolist(), (per_text * 4).tolist()):
            out[i] = data[end - n : end]
        at = np.flatnonzero(whole).tolist()
        for i, found in zip(at, self._encoded([texts[i].as_py() for i in at])):
            out[i] = np.array(found, "<u4").tobytes()
        return out


def word_encoder(path: str) -> WordEncoder:
    return per_worker("word_encoder_" + path, lambda: WordEncoder(path))
