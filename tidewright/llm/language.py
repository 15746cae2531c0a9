"""Which language a text is mostly written in, by script, function words and letters that only some languages use."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewright.llm import kernels as K

#: Function words that (nearly) only one of the languages written in Latin letters uses; none of the first four languages
#: stands in a later list. Fixed values.
FUNCTION_WORDS = {
    "en": "the of and to is are was that with for from on before after it each this which when should by at has have had they their there would could been were will what how can if into than then its our your you we not as be",
    "de": "der das und den dem nicht mit von bei auf ist ein eine einen einer wenn sich im zu wie nach vor damit zum zur alle ich wird werden sind oder auch aus für über unter durch noch nur aber dass ohne was warum kann man hat es",
    "fr": "le les et est une du dans pour sur avec qui il elle au aux ce cette pas plus sans quand avant après par nous vous ils sont mais ou où leur ses son je ne comment pourquoi chez puis toutes tous près dès cela être fait",
    "es": "el los las y una con por para del al más antes cuando lo su hasta sin como pero fue son están esta este ese cada desde sobre entre también muy hay qué cómo unas unos sus nos le yo bajo tras aunque luego",
    "it": "gli che della delle degli dei nel nella sono per questo questa anche più perché come dopo prima quando essere stato ogni loro alla dalla sulla dal sul cui ancora molto senza tutti viene può non di",
    "pt": "não uma com dos pelo pela você seu sua isso também muito ao em um os foi então até já esse essa quem depois ainda eles ela são quando onde pode deve nas da na",
    "nl": "het een van niet dat deze zijn worden wordt voor met naar ook maar wel bij uit kan moet heeft door over deze dit daar waar wanneer dan nog geen onder tussen",
    "sv": "och att det som är av för med till inte på har kan ska från när men om eller vid efter också alla mellan under över utan där här detta",
    "da": "og det som er af med til ikke på har kan skal fra når men om eller ved efter også mellem under over uden hvor dette blev",
    "pl": "nie na się jest że jak od po przez dla jego jej ale oraz być które który tylko już może gdy aby przed także są",
    "cs": "na že jako pro ale které který jen už může když aby před také jsou není při nebo podle",
    "ro": "și în nu cu pe că sunt din pentru mai după prin fără între acest această care fost poate dar sau când toate lui",
    "tr": "ve bir bu için ile da çok daha olarak gibi ancak değil olan sonra önce kadar her veya ise nasıl neden olduğu",
    "id": "yang dan di dari untuk dengan tidak ini itu pada adalah ke oleh akan dalam atau juga sudah karena saat harus setelah sebelum",
    "vi": "và của là không có được cho trong một các với này đã để khi từ người những phải trước sau nếu",
}
#: Letters that only one of these languages uses; a word with one counts like a function word. Fixed values.
OWN_LETTERS = {"de": "ß", "es": "ñ", "pt": "ãõ", "pl": "łżźśćńęą", "cs": "řěůť", "ro": "țșă", "tr": "ğışİ", "vi": "ơưđạảấầậắằặẻẽẹếềểễệịỏọốồổộớờởợụủứừửựỳỵỷỹ"}
#: Languages by the first word of the Unicode names of their letters. Fixed values.
SCRIPT_LANGUAGES = {
    "CJK": "zh", "HIRAGANA": "ja", "KATAKANA": "ja", "HANGUL": "ko", "CYRILLIC": "ru", "ARABIC": "ar", "HEBREW": "he", "GREEK": "el", "DEVANAGARI": "hi", "BENGALI": "bn", "GURMUKHI": "pa", "GUJARATI": "gu",
    "TAMIL": "ta", "TELUGU": "te", "KANNADA": "kn", "MALAYALAM": "ml", "SINHALA": "si", "THAI": "th", "LAO": "lo", "MYANMAR": "my", "KHMER": "km", "GEORGIAN": "ka", "ARMENIAN": "hy", "ETHIOPIC": "am", "TIBETAN": "bo",
}
#: Languages that share a script with another one, by letters that the other one lacks. Fixed values.
SIDE_LANGUAGES = {"uk": ("CYRILLIC", "іїєґ"), "be": ("CYRILLIC", "ў"), "sr": ("CYRILLIC", "ђћџљњ"), "fa": ("ARABIC", "پچژگ"), "ur": ("ARABIC", "ٹڈڑے")}
#: A decision among Latin languages needs this many function words, and this lead over the next language.
LEAST_WORDS, LEAD = 2, 1.4
#: Share of words from which a script other than Latin is the text's own (Han characters are words of their own), least such
#: words, share of kana among those of a Japanese text, and share of its letters that shows a side language.
SCRIPT_SHARE, LEAST_SCRIPT, KANA_SHARE, SIDE_SHARE = 0.35, 2, 0.1, 0.02

_SCRIPTS = ("LATIN", *SCRIPT_LANGUAGES)
#: Letters from here on may belong to other scripts than Latin.
_BEYOND_LATIN = 0x370


@lru_cache(maxsize=1)
def _tables() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages in Latin letters, sorted hashes of function words with their languages (bits), and the languages that own a letter (bits) by code point."""
    owners = np.zeros(0x10000, np.uint32)
    for k, name in enumerate(FUNCTION_WORDS):
        for letter in OWN_LETTERS.get(name, ""):
            owners[ord(letter)] |= np.uint32(1 << k)
    listed = [K.hash_set(words.split()) for words in FUNCTION_WORDS.values()]
    known = np.unique(np.concatenate(listed))
    bits = np.zeros(len(known), np.uint32)
    for k, words in enumerate(listed):
        bits[np.searchsorted(known, words)] |= np.uint32(1 << k)
    return list(FUNCTION_WORDS), known, bits, owners


@lru_cache(maxsize=1)
def _script_table() -> np.ndarray:
    """Place of the script of each code point of the basic plane; whatever has none counts as Latin."""
    place = {name: k for k, name in enumerate(_SCRIPTS)}
    found = np.zeros(0x10000, np.uint8)
    for code in range(_BEYOND_LATIN, 0x10000):
        found[code] = place.get(unicodedata.name(chr(code), "").partition(" ")[0], 0)
    return found


def _scripts(text: K.Chars, w: K.Words) -> np.ndarray:
    """Words of each text by script (rows) and text (columns)."""
    first = text.low[w.start]
    odd = np.flatnonzero(first >= _BEYOND_LATIN)
    table = _script_table()
    script = np.where(first[odd] < 0x10000, table[np.minimum(first[odd], 0xFFFF)], np.where((text.kind[w.start[odd]] & K.HAN) > 0, _SCRIPTS.index("CJK"), 0)).astype(np.int64)
    counts = np.bincount(script * text.docs + w.doc[odd], minlength=len(_SCRIPTS) * text.docs).reshape(len(_SCRIPTS), text.docs)
    counts[0] += K.per_doc(w.doc, text.docs).astype(np.int64) - counts.sum(axis=0)
    return counts


def detect_block(text: K.Chars, w: K.Words | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(language, script) of the texts of a block; None where too little speaks for one of them. ``w``: its words of letters and marks."""
    names, known, bits, owners = _tables()
    w = K.words(text, K.LETTER | K.MARK) if w is None else w
    n = K.per_doc(w.doc, text.docs)
    at = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
    found = np.flatnonzero(known[at] == w.hash)
    doc, mine = w.doc[found], bits[at[found]]
    hits = np.stack([np.bincount(doc[(mine >> np.uint32(k)) & np.uint32(1) > 0], minlength=text.docs).astype(float) for k in range(len(names))])
    letters = np.flatnonzero((text.low >= 0x80) & (text.low < 0x10000))
    letters = letters[owners[text.low[letters]] > 0]
    if len(letters):
        at = np.unique(np.searchsorted(w.start, letters, side="right") - 1, return_index=True)
        word, owner = at[0], owners[text.low[letters[at[1]]]]
        for k in range(len(names)):
            hits[k] += K.per_doc(w.doc[word], text.docs, (owner >> np.uint32(k)) & np.uint32(1))
    order = np.sort(hits, axis=0)
    clear = (order[-1] >= LEAST_WORDS) & (order[-1] >= LEAD * order[-2])
    code = np.array([*names, None], object)[np.where(clear, np.argmax(hits, axis=0), len(names))]
    script = np.where(n > 0, np.array(["LATIN"], object), None)
    if len(w.start) and (text.low[w.start] >= _BEYOND_LATIN).any():
        counts = _scripts(text, w)
        place = {name: k for k, name in enumerate(_SCRIPTS)}
        kana = counts[place["HIRAGANA"]] + counts[place["KATAKANA"]]
        east = counts[place["CJK"]] + kana
        counts[place["HIRAGANA"]] = np.where(kana >= KANA_SHARE * np.maximum(east, 1), np.where(kana > 0, east, 0), 0)
        counts[place["KATAKANA"]] = 0
        counts[place["CJK"]] = np.where(counts[place["HIRAGANA"]] > 0, 0, east)
        best = 1 + np.argmax(counts[1:], axis=0)
        most = counts[best, np.arange(text.docs)]
        own = (most >= LEAST_SCRIPT) & (most >= SCRIPT_SHARE * np.maximum(n, 1))
        script[own] = np.array(_SCRIPTS, object)[best[own]]
        code[own] = np.array([None, *SCRIPT_LANGUAGES.values()], object)[best[own]]
        _side_languages(text, script, code)
    return code, script


def _side_languages(text: K.Chars, script: np.ndarray, code: np.ndarray) -> None:
    for name, (shared, own) in SIDE_LANGUAGES.items():
        if (script == shared).any():
            at = np.flatnonzero(np.isin(text.low, [ord(c) for c in own]))
            letters = np.add.reduceat(np.append((text.kind & K.LETTER) > 0, False).astype(np.int64), np.minimum(text.offset[:-1], len(text.kind)))
            shown = K.per_doc(text.doc_of(at), text.docs) >= np.maximum(1, SIDE_SHARE * letters)
            code[(script == shared) & shown] = name


def detect(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Language codes of texts, null where undecided or empty."""
    found = [detect_block(block)[0] for _, _, block in K.blocks(texts)]
    return pa.array(np.concatenate(found) if found else [], pa.string())


def _detect_array(texts: pa.Array) -> pa.Array:
    return detect(texts)


def language_of(column: Column) -> Column:
    """Column form of :func:`detect`."""
    return F.arrow_udf(_detect_array, StringType())(column)


def _both_array(texts: pa.Array) -> pa.Array:
    found = [detect_block(block) for _, _, block in K.blocks(texts)]
    columns = [np.concatenate([f[k] for f in found]) if found else [] for k in (0, 1)]
    return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], ["language", "script"])


def language_and_script(column: Column) -> Column:
    """Struct (language, script) of a text; the script is null for texts without letters."""
    return F.arrow_udf(_both_array, StructType([StructField("language", StringType()), StructField("script", StringType())]))(column)
