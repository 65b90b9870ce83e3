"""Quality rules, line first: drop failing lines, then reject documents that lose too much text.

A line with a word fails if

* punctuation: no sentence ends in it (no terminal punctuation, optionally with
  quotes or brackets after it, before white space or the line's end), or every
  fifth word or more ends in ``!!`` or ``??``;
* navigation: it is a menu: a ``|`` (or ``>``, ``»``, bullet) for every third
  word or more, and two at least;
* symbols: it has a symbol character for every fifth word or more, and three at
  least;
* boilerplate: it holds a phrase of licence, rights, cookie or script notices in
  English, French, German or Spanish (``PHRASES``).

The document is kept if its base rules hold (20 words at least; at most 30 % of
the words in 8-word windows that occur twice or more) and the failing lines
hold at most ``MAX_LOST`` of its words.  Blank lines neither fail nor count.

Window repetition is counted on 64-bit hashes of words and windows, batch-wise
in numpy; a text is always worked through whole.

Defined cases: null and empty texts have no words, so they fail the base rules;
repeated rows are judged alike; an empty table gives an empty result; extra
columns are kept by ``clean`` (columns of its outputs' names are replaced).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LOST = 0.5
SYMBOLS = "#*$%&|<>"
MENU = "|>»•·"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACES = " \t\n\v\f\r"
_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*(?:[\x20\x09-\x0D]|$)")
_SHOUT = re.compile(r"[!?]{2,}")
#: Phrases of licence, rights, cookie and script notices, by language.
PHRASES = {
    "en": r"all rights reserved|licensed under|released under the|general public license|creative commons|"
          r"terms of (?:use|service)|privacy policy|cookie policy|accept cookies|enable javascript|lorem ipsum|"
          r"sign up for our newsletter",
    "fr": r"tous droits réservés|sous licence (?:libre|publique|creative)|licence publique générale|"
          r"conditions (?:générales )?d['’]utilisation|politique de confidentialité|accepter les cookies|"
          r"activer javascript|mentions légales|abonnez-vous à notre",
    "de": r"alle rechte vorbehalten|lizenziert unter|veröffentlicht unter der|nutzungsbedingungen|"
          r"datenschutzerklärung|cookies akzeptieren|javascript aktivieren|abonnieren sie unseren newsletter",
    "es": r"todos los derechos reservados|bajo la licencia|licencia pública general|"
          r"(?:términos|condiciones) de (?:uso|servicio)|política de (?:privacidad|cookies)|aceptar (?:las )?cookies|"
          r"activar javascript|aviso legal|suscríbete a nuestro",
}
_BOILERPLATE = re.compile("|".join(PHRASES.values()))
#: Every phrase holds one of these; a text with none of them is not searched line by line.
HINTS = ("rights", "licen", "lizenz", "released under", "creative commons", "terms of", "policy", "cookie", "javascript",
         "lorem ipsum", "newsletter", "droits", "d'utilisation", "d’utilisation", "confidentialité", "légales",
         "abonnez", "vorbehalten", "veröffentlicht unter", "nutzungsbedingungen", "datenschutzerklärung", "derechos",
         "términos", "condiciones", "privacidad", "aviso legal", "suscríbete")


def repeat_words(texts: list[str | None], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(words of each text, words in windows of ``size`` words that occur twice or more in the text)."""
    h, count = hashing.words(hashing.as_bytes(texts))
    n = len(h) - size + 1
    out = np.zeros(len(texts), np.int64)
    if n <= 0:
        return count, out
    doc = np.repeat(np.arange(len(texts)), count)
    key = np.zeros(n, np.uint64)
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    inside = np.flatnonzero(doc[:n] == doc[size - 1:])  # windows within one text
    key = hashing.mix(key[inside] ^ hashing.mix(doc[inside].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, inside[twice], 1)
    np.add.at(cover, inside[twice] + size, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return count, np.bincount(doc[covered], minlength=len(texts))


def line_fails(line: str, notices: bool = True) -> str | None:
    """Name of the first rule that a line with a word fails, or None; without ``notices`` no phrase is looked for."""
    n = len(_WORD.findall(line))
    menu = sum(map(line.count, MENU))
    if menu >= 2 and 3 * menu >= n:
        return "navigation"
    symbols = sum(map(line.count, SYMBOLS))
    if symbols >= 3 and 5 * symbols >= n:
        return "symbols"
    if not _END.search(line) or 5 * len(_SHOUT.findall(line)) >= max(n, 5):
        return "punctuation"
    return "boilerplate" if notices and _BOILERPLATE.search(line.lower()) else None


def judge(text: str | None) -> tuple:
    """word_chars, n_symbols, n_dup_lines, lost words, kept text."""
    text = text or ""
    lines = text.split("\n")
    worded = [x for x in lines if x.strip(_SPACES)]
    lost, kept, low = 0, [], text.lower()
    notices = any(h in low for h in HINTS)
    for x in lines:
        if x.strip(_SPACES) and line_fails(x, notices):
            lost += len(_WORD.findall(x))
        else:
            kept.append(x)
    return (len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, SYMBOLS)), len(worded) - len(set(worded)),
            lost, "\n".join(kept))


COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "lost_words long, kept boolean, clean_text string")


def clean(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with the counts, base_failed, lost_words, kept and clean_text (without the failing lines)."""

    @F.pandas_udf(COLUMNS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [_rows(r, max_lost) for r in hashing.runs(list(batch))]
            yield pd.concat(parts, ignore_index=True) if parts else _rows([], max_lost)

    made = docs.withColumn("__rules", run(text))
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return made.withColumns({c: F.col(f"__rules.{c}") for c in names}).drop("__rules")


def _rows(texts: list[str | None], max_lost: float) -> pd.DataFrame:
    n_words, n_repeat = repeat_words(texts)
    out = pd.DataFrame([judge(t) for t in texts],
                       columns=["word_chars", "n_symbols", "n_dup_lines", "lost_words", "clean_text"])
    out.insert(0, "n_words", n_words)
    out.insert(4, "n_repeat_words", n_repeat)
    out.insert(5, "base_failed", (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words))
    out.insert(7, "kept", ~out["base_failed"] & (out["lost_words"] <= max_lost * n_words))
    return out
