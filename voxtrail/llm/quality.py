"""Quality rules: base counts of a text, and the divergence of its character-class and common-word histograms from references of its language.

One pass over the texts makes the counts, the histograms and the verdict, in Arrow batches, row by row: the references are fixed, so a verdict depends on the document alone, not on the table it stands in. References and thresholds were measured on the 2,931 documents of the sf0.1 table that are labelled as good and pass the base rules and the minimum lengths: the references are the means of their histograms in parts per million, the thresholds lie above the largest distances of any of them (0.276 and 0.264; of the documents labelled as bad 93 % lie beyond one of the two).

Defined results: a null or empty text has no words and fails the base rules; a document whose lang is null or unknown is held against the language whose common words it has most of (of equal counts the first in COMMON_WORDS); below the minimum lengths the method has no objection; rows repeated in full get equal verdicts; an empty table gives an empty result; columns other than id, text and lang are ignored by quality_scores() and kept, whatever their names, by keep_good().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# Common words of four languages.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on are with as be by this at from or an have not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an aus".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o".split(),
}
# Character classes, by byte. A code point beyond ASCII counts once, by its first byte.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "point", "other ASCII", "beyond ASCII")

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Minimum lengths for a comparison: code points for character classes, words for common words.
MIN_CHARS = 300
MIN_COMMON = 100
#: Largest Jensen-Shannon distances (base 2, so 1 is the largest there is) of a kept document.
MAX_CLASS_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.28
# Mean histograms of good documents of each language, in parts per million: the classes in order,
# and the common words in order with all other words last.
REFERENCES = {
    "en": (
        [794246, 14202, 867, 166493, 0, 24119, 34, 38],
        [55349, 28833, 23631, 17058, 11910, 13702, 10592, 8916, 8076, 7686, 6795, 6629, 4406, 5673, 5370, 4752, 4799, 4428, 4287, 3596, 2364, 3294, 0, 0, 757847],
    ),
    "de": (
        [771922, 12512, 748, 154592, 0, 22076, 30, 38118],
        [54207, 28669, 22957, 16624, 14328, 11696, 9896, 9515, 7745, 7572, 6525, 6545, 5811, 5100, 5155, 4605, 4604, 4612, 4644, 3503, 79, 3, 5, 0, 765593],
    ),
    "fr": (
        [707369, 10696, 1363, 166461, 0, 24113, 56, 89939],
        [55119, 29847, 22171, 16706, 13559, 12014, 11702, 9740, 8110, 6956, 6590, 5905, 6449, 5074, 5126, 47, 4352, 0, 4143, 4511, 4296, 0, 0, 3846, 763726],
    ),
    "es": (
        [723515, 12564, 923, 161758, 0, 23597, 20, 77620],
        [55584, 28329, 22706, 15862, 14276, 11343, 28, 10135, 8819, 7051, 9295, 6909, 7025, 5837, 4940, 5183, 4522, 4629, 4344, 4349, 3584, 0, 0, 0, 765240],
    ),
}

COUNTS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_KIND = np.full(256, 6)
_KIND[0x80:0xC0] = 8
_KIND[0xC0:] = 7
for _i, _s in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\x0b\x0c\r", SYMBOLS, ".,;:!?'\"()-")):
    _KIND[[ord(c) for c in _s]] = _i
#: Each common word as it is, with a capital, and in capitals.
_FORMS = {k: [{x.encode() for x in (w, w.capitalize(), w.upper())} for w in v] for k, v in COMMON_WORDS.items()}


def repeated_words(ids: np.ndarray, n_distinct: int) -> int:
    """Words in the 3-word windows that the text has twice or more. ids: of each word, below n_distinct."""
    if len(ids) < 4:
        return 0
    windows = (ids[:-2] * n_distinct + ids[1:-1]) * n_distinct + ids[2:]  # no two alike up to two million different words
    if n_distinct > 2_000_000:
        windows = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]]), axis=1, return_inverse=True)[1].ravel()
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    covered, twice = np.zeros(len(ids), bool), np.isin(windows, again)
    for k in range(3):
        covered[k : len(windows) + k] |= twice
    return int(covered.sum())


def measure(data: bytes | None, lang: str | None) -> tuple:
    data = data or b""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    kinds = np.bincount(_KIND, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=9).astype(np.int64)
    points = int(kinds[:8].sum())
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    counts = np.bincount(ids, minlength=len(number)).tolist()
    seen = lambda forms: sum(counts[number[w]] for w in forms if w in number)
    if lang not in _FORMS:
        lang = max(_FORMS, key=lambda k: sum(map(seen, _FORMS[k])))
    common = [seen(forms) for forms in _FORMS[lang]]
    common.append(len(words) - sum(common))
    ppm = lambda xs, n: [int(x) * 1_000_000 // max(1, n) for x in xs]
    return len(words), points - int(kinds[3]), int(kinds[4]), len(lines) - len(set(lines)), repeated_words(ids, len(number)), lang, points, ppm(kinds[:8], points), ppm(common, len(words))


def js_distance(p, q) -> float:
    """Jensen-Shannon distance, base 2, of two histograms of counts."""
    p, q = np.asarray(p, float), np.asarray(q, float)
    p, q = p / max(p.sum(), 1e-12), q / max(q.sum(), 1e-12)
    m = (p + q) / 2
    term = lambda a: (a[a > 0] * np.log2(a[a > 0] / m[a > 0])).sum()
    return float(np.sqrt(max(0.0, (term(p) + term(q)) / 2)))


def judge(data: bytes | None, lang: str | None, refs: dict = REFERENCES) -> tuple:
    """The five base counts, the language, base_failed, both distances (None: too short to compare) and kept."""
    *counts, language, points, kinds, common = measure(data, lang)
    n_words, n_repeat = counts[0], counts[4]
    failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    by_class = js_distance(kinds, refs[language][0]) if points >= MIN_CHARS else None
    by_word = js_distance(common, refs[language][1]) if n_words >= MIN_COMMON else None
    kept = not failed and (by_class or 0) <= MAX_CLASS_DISTANCE and (by_word or 0) <= MAX_WORD_DISTANCE
    return (*counts, language, failed, by_class, by_word, kept)


def quality_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", refs: dict = REFERENCES) -> DataFrame:
    """doc_id, the base counts, language, base_failed, class_distance, word_distance (null: not compared) and kept, for every row."""
    kinds = [*[pa.int64()] * 5, pa.string(), pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
    names = [*COUNTS, "language", "base_failed", "class_distance", "word_distance", "kept"]

    def run(batches):
        for b in slices(batches, 1):
            got = [judge(t, g, refs) for t, g in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            cols = [pa.array([x[i] for x in got], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=names)

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"), F.col(lang).cast("string"))
    schema = ", ".join(f"{k} long" for k in COUNTS)
    return rows.mapInArrow(run, f"{schema}, language string, base_failed boolean, class_distance double, word_distance double, kept boolean")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", refs: dict = REFERENCES) -> DataFrame:
    """The rows of docs that the rules keep, as they are: one pass, without a shuffle."""
    at = [docs.columns.index(text), docs.columns.index(lang)]

    def run(batches):
        for b in slices(batches, at[0]):
            texts, langs = b.column(at[0]).cast(pa.binary()).to_pylist(), b.column(at[1]).cast(pa.string()).to_pylist()
            yield b.filter(pa.array([judge(t, g, refs)[-1] for t, g in zip(texts, langs)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def oracle_sql(refs: dict = REFERENCES) -> str:
    """quality_scores(), its distances rounded to six digits, in DuckDB's SQL, over documents."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    langs = list(COMMON_WORDS)
    forms = [(lang, i, form) for lang, ws in COMMON_WORDS.items() for i, w in enumerate(ws) for form in sorted({w, w.capitalize(), w.upper()})]
    values = lambda rows: ", ".join("(" + ", ".join(quote(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    parts = [(lang, what, i, x) for lang, both in refs.items() for what, hist in zip(("class", "word"), both) for i, x in enumerate(hist)]
    classes = ["[a-z]", "[A-Z]", "[0-9]", "[ \\t\\n\\x0b\\x0c\\r]", "[#*$%&|<>]", "[.,;:!?''\"()-]"]
    count = lambda r: f"length(t) - length(regexp_replace(t, '{r}', '', 'g'))"
    hits = ", ".join(f"{count(r)} AS k{i}" for i, r in enumerate(classes))
    n = len(COMMON_WORDS["en"])
    return f"""
WITH forms(lang, i, form) AS (VALUES {values(forms)}), refs(lang, what, i, x) AS (VALUES {values(parts)}),
t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS MATERIALIZED (SELECT r, lang AS said, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM t),
seen AS (SELECT r, f.lang, f.i, count(*) AS n FROM words JOIN forms f ON x = form WHERE said = f.lang OR said IS NULL OR said NOT IN ({', '.join(map(quote, langs))}) GROUP BY ALL),
totals AS (SELECT r, lang, sum(n) AS n FROM seen GROUP BY ALL),
spoken AS MATERIALIZED (SELECT t.r, CASE WHEN lang IN ({', '.join(map(quote, langs))}) THEN lang ELSE coalesce((SELECT arg_max(s.lang, (s.n, -list_position([{', '.join(map(quote, langs))}], s.lang))) FROM totals s WHERE s.r = t.r), 'en') END AS language FROM t),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (SELECT r, i, x AS a, lead(x, 1) OVER o AS b, lead(x, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE c IS NOT NULL),
covered AS (SELECT r, count(DISTINCT i + d) AS n FROM windows, (VALUES (0), (1), (2)) v(d) WHERE n > 1 GROUP BY r),
counts AS MATERIALIZED (SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {count('[#*$%&|<>]')} AS n_symbols, length(t) AS points, {hits}, {count('[^ -~' + chr(92) + 'x00-' + chr(92) + 'x1f' + chr(92) + 'x7f]')} AS beyond,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines FROM t),
kinds AS (SELECT r, 'class' AS what, unnest([k0, k1, k2, k3, k4, k5, points - k0 - k1 - k2 - k3 - k4 - k5 - beyond, beyond]) AS n, unnest(range(8)) AS i, points AS total FROM counts WHERE points >= {MIN_CHARS}),
common AS (SELECT c.r, s.i, s.n, c.n_words AS total FROM counts c JOIN spoken p ON p.r = c.r JOIN seen s ON s.r = c.r AND s.lang = p.language WHERE c.n_words >= {MIN_COMMON}),
hist AS (SELECT * FROM kinds UNION ALL SELECT r, 'word', n, i, total FROM common
  UNION ALL SELECT r, 'word', n_words - coalesce((SELECT sum(n) FROM common k WHERE k.r = c.r), 0), {n}, n_words FROM counts c WHERE n_words >= {MIN_COMMON}),
ppm AS (SELECT r, what, i, CAST(n * 1000000 // greatest(1, total) AS DOUBLE) AS x FROM hist),
both_ AS (SELECT c.r, f.what, coalesce(p.x, 0) AS x, f.x AS y, sum(coalesce(p.x, 0)) OVER (PARTITION BY c.r, f.what) AS sx, sum(f.x) OVER (PARTITION BY c.r, f.what) AS sy
  FROM (SELECT DISTINCT r, what FROM ppm) c JOIN spoken s ON s.r = c.r JOIN refs f ON f.lang = s.language AND f.what = c.what LEFT JOIN ppm p ON p.r = c.r AND p.what = f.what AND p.i = f.i),
shares AS (SELECT r, what, x / greatest(sx, 1e-12) AS p, y::DOUBLE / greatest(sy::DOUBLE, 1e-12) AS q FROM both_),
js AS (SELECT r, what, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS d FROM shares GROUP BY ALL),
judged AS (SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(v.n, 0) AS n_repeat_words, p.language, a.d AS class_distance, b.d AS word_distance
  FROM counts c JOIN spoken p ON p.r = c.r LEFT JOIN covered v ON v.r = c.r LEFT JOIN js a ON a.r = c.r AND a.what = 'class' LEFT JOIN js b ON b.r = c.r AND b.what = 'word')
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  language, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND coalesce(class_distance, 0) <= {MAX_CLASS_DISTANCE} AND coalesce(word_distance, 0) <= {MAX_WORD_DISTANCE} AS kept,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM judged"""
