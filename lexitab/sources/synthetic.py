"""Synthetic dictionaries: repeatable from (attempt, seed) under any partitioning."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexitab.functions.text import capitalize
from lexitab.operators.ordering import distinct_first, first_n, stable_sort
from lexitab.session import materialise

ATTEMPTS_PER_ROW = 10
MIN_VALUE_BYTES, MAX_VALUE_BYTES = 5000, 12000
MEAN_ROW_BYTES = 8_500
PARTITION_BYTES = 128 * 1024 ** 2
# Fixed value: the prime whose residues are drawn; squares of them fit a long.
PRIME = 2_147_483_647
# Words of a sentence, on average and at most, and what may end it.
SENTENCE, LONGEST = 9, 24
MARKS = (".", ".", ".", "?", ".", "!", ".")
# Values whose draws are held at a time.
ROWS = 16

# Title templates.  {Word}, {WORD} change the case of {word}; {a|b} is a choice; {words:1-3} repeats;
# the choice between templates is uniform.
SMALL_TEMPLATES = """
{word}
{Word}
{WORD}
{Word}-{Word}
{word} {word} {word}
{Word} {last}
{first} {last}
{last} & {last}
{city}
{street}
{company}
{job}
{color} {word}
{phrase}
{words:1-3}
{sentence:3-6}
{acronym:3-5}
mis{word}
{word}ful
""".strip().splitlines()

FULL_TEMPLATES = SMALL_TEMPLATES + """
{word}/{word}
{Word} ({word})
{Word}, {word}
{Word}'s {word}
{word}{word}
{country}
{state}
{cut:2-4}-{cut:2-4}
St. {first}
Prof. {last}
{first} of {city}
{last} {constant|equation|number}
{street}, {city}
{city} {Airport|Harbour|Library|Station}
{East|West} {city}
{country} {Archive|Cup|Institute}
{company} {Group|Partners|Works}
{Early|Late} {word}
{Copper|Iron|Silver} {Word}
{word} {model|paradox|principle}
{Bridge|Museum|Theatre} of {Word}
{Captain|Duke|Sister} {last}
{word} ({first|second|third} edition)
inter{word}
sub{word}
{word}dom
{word}less
{word}like
{word}ship
{word}ward
How to {word}
List of {word}s
""".strip().splitlines()

# Word material of our own.
FIRST = "Ada Bela Carl Dora Emil Fay Gus Hana Ivo Jana Karl Lena Max Nora Otto Pia Quin Rosa Sam Tina Uwe Vera Will Zoe"
COUNTRY = ("Austria|Belgium|Brazil|Canada|Chile|Denmark|Egypt|Finland|France|Ghana|Greece|India|Ireland|Italy|Japan|"
           "Kenya|Mexico|Nepal|New Zealand|Norway|Peru|Poland|Portugal|Spain|Sweden|Turkey|Uruguay|Vietnam")
STATE = "Alabama Alaska Arizona Colorado Florida Georgia Hawaii Idaho Iowa Kansas Maine Nevada Ohio Oregon Texas Utah Vermont"
COLOR = "Azure Beige Brown Coral Crimson Gold Green Indigo Ivory Khaki Lavender Maroon Olive Orchid Plum Salmon Teal Violet"
JOB = ("Accountant|Architect|Baker|Chemist, analytical|Designer, textile|Editor|Engineer, civil|Geologist|Illustrator|"
       "Librarian|Musician|Nurse, adult|Optometrist|Pilot|Surveyor, land|Translator|Writer")
ADJECTIVE = "Adaptive Balanced Compact Digital Extended Focused Layered Managed Open Phased Robust Shared Tiered Upgraded"
NOUN = "alliance archive benchmark capability database framework hub initiative matrix model portal standard toolset"
LAST_END = "son man ford ton ley er berg well field"
CITY_END = "ville burg port ton mouth stad haven side"
STREET_END = "Street Avenue Road Lane Drive Way Place Court"


def _vocabulary(size: int = 2048) -> str:
    """Words built by rule from syllables, blank-separated."""
    onsets, vowels, codas = "b d f g h k l m n p r s t v z st".split(), "aeiou", ["", "n", "r", "l", "s", "m"]

    def syllable(i: int) -> str:
        i, coda = divmod(i, len(codas))
        i, vowel = divmod(i, len(vowels))
        return onsets[i % len(onsets)] + vowels[vowel] + codas[coda]

    return " ".join(syllable(i * 7) + syllable(i * 31 + i // 480) for i in range(size))


WORDS = _vocabulary()


class _Draw:
    """Repeatable draws for one row: every draw is a hash of the row's key and a tag.

    The key is a hash of seed and attempt; ``each`` gives every element of a sequence a key of
    its own, made once per element.
    """

    def __init__(self, key: Column, vocabulary: str = WORDS):
        self.key = key
        self.vocabulary = vocabulary

    @classmethod
    def of(cls, seed: int, *path: Column, vocabulary: str = WORDS) -> "_Draw":
        return cls(F.xxhash64(F.lit(seed), *path), vocabulary)

    def at(self, key: Column) -> "_Draw":
        """Draws from the same vocabulary under another key."""
        return _Draw(key, self.vocabulary)

    def each(self, low: int, high: Column, text: Callable[["_Draw"], Column]) -> Column:
        """An array of ``text`` for ``low..high``."""
        keys = F.transform(F.sequence(F.lit(low), high), lambda i: F.xxhash64(self.key, i))
        return F.transform(keys, lambda key: text(self.at(key)))

    def number(self, tag: int, low: int | Column, high: int | Column) -> Column:
        """Uniform in ``low..high``."""
        low, high = (F.lit(x) if isinstance(x, int) else x for x in (low, high))
        drawn = F.xxhash64(self.key, F.lit(tag))
        return (F.pmod(drawn, (high - low + 1).cast("long")) + low).cast("int")

    def pick(self, tag: int, words: str, separator: str = " ") -> Column:
        size = words.count(separator) + 1
        # A split of one literal is folded to an array literal when the plan is made.
        options = F.split(F.lit(words), re.escape(separator))
        return F.element_at(options, self.number(tag, 1, size))

    def word(self, tag: int = 0) -> Column:
        return self.pick(tag, self.vocabulary)

    def capital(self, tag: int = 0) -> Column:
        return capitalize(self.word(tag))

    def words(self, tag: int, low: int, high: Column) -> Column:
        """Words number ``low`` to ``high``: one hash each."""
        size = self.vocabulary.count(" ") + 1
        options = F.split(F.lit(self.vocabulary), " ")
        drawn = F.transform(F.sequence(F.lit(low), high), lambda j: F.element_at(
            options, (F.pmod(F.xxhash64(self.key, F.lit(tag), j), F.lit(size)) + 1).cast("int")))
        return F.concat_ws(" ", drawn)


def _token(token: Column, draw: _Draw) -> Column:
    """The text of one template token."""
    last = F.concat(draw.capital(10), draw.pick(11, LAST_END))
    other_last = F.concat(draw.capital(12), draw.pick(13, LAST_END))
    repeats = F.split(F.regexp_extract(token, r":(\d+-\d+)", 1), "-")
    count = draw.number(20, repeats[0].cast("int"), repeats[1].cast("int"))
    initials = draw.each(1, count, lambda each: F.upper(F.substring(each.word(), 1, 1)))
    options = F.split(F.regexp_replace(token, "[{}]", ""), r"\|")
    choice = F.element_at(options, draw.number(21, F.lit(1), F.size(options)))
    plain = draw.words(0, 1, count)
    texts = {
        "{word}": draw.word(),
        "{Word}": draw.capital(),
        "{WORD}": F.upper(draw.word()),
        "{first}": draw.pick(1, FIRST),
        "{last}": last,
        "{city}": F.concat(draw.capital(), draw.pick(1, CITY_END)),
        "{country}": draw.pick(1, COUNTRY, "|"),
        "{company}": F.when(draw.number(2, 0, 1) == 0, F.concat(last, F.lit(" Brothers")))
                      .otherwise(F.concat_ws(" & ", last, other_last)),
        "{state}": draw.pick(1, STATE),
        "{street}": F.concat_ws(" ", last, draw.pick(1, STREET_END)),
        "{phrase}": F.concat_ws(" ", draw.pick(1, ADJECTIVE), draw.word(), draw.pick(2, NOUN)),
        "{color}": draw.pick(1, COLOR),
        "{job}": draw.pick(1, JOB, "|"),
    }
    text = F.when(~token.startswith("{"), token)
    for name, value in texts.items():
        text = text.when(token == name, value)
    return (text.when(token.startswith("{words:"), plain)
            .when(token.startswith("{sentence:"), capitalize(plain))
            .when(token.startswith("{acronym:"), F.concat_ws("", initials))
            .when(token.startswith("{cut:"), F.upper(F.substring(draw.word(), F.lit(1), count)))
            .otherwise(choice))


def title(attempt: Column, seed: int, templates: list[str] = FULL_TEMPLATES, vocabulary: str = WORDS) -> Column:
    """One of the templates, each equally likely, filled in."""
    draw = _Draw.of(seed, attempt, vocabulary=vocabulary)
    tokens = "\n".join("\t".join(t for t in re.split(r"(\{[^}]*\})", line) if t) for line in templates)
    template = F.split(F.element_at(F.split(F.lit(tokens), "\n"), draw.number(100, 1, len(templates))), "\t")
    return F.concat_ws("", F.transform(template, lambda token, i: _token(token, draw.at(F.xxhash64(draw.key, i)))))


def _key(attempt: Column, seed: int, use: int) -> Column:
    """A number below PRIME for an attempt, a seed and a use: whole-number arithmetic that any engine repeats."""
    first = F.array((attempt % PRIME + (seed * 7_368_787 + use * 15_485_863) % PRIME) % PRIME)
    second = F.transform(first, lambda x: (x * x + 99_991) % PRIME)
    return F.transform(second, lambda x: (x * x + attempt + use) % PRIME)[0]


@lru_cache(maxsize=4)
def _vocabulary_tables(vocabulary: str) -> tuple[np.ndarray, pa.Array]:
    """What a word takes, in bytes and one more, and each word as it is written: small or capital, with no mark or each."""
    words = vocabulary.split(" ")

    def capital(word: str) -> str:
        # As in functions.text: letter by letter.
        first = word[:1].upper() if len(word[:1].upper()) == 1 else word[:1].replace("ß", "ẞ")
        return first + word[1:].lower()

    written = [form + mark for word in words for form in (word, capital(word)) for mark in ("", *MARKS)]
    return np.array([len(word.encode()) + 1 for word in words]), pa.array(written, pa.string())


def _folded(x: np.ndarray) -> np.ndarray:
    """``x`` modulo PRIME, which is 2 ** 31 - 1, as 0 to 2 ** 31: PRIME itself and one more stand for 0 and 1.

    ``x``, a new array, is changed."""
    for _ in range(2):
        high = x >> 31
        x &= PRIME
        x += high
    return x


def _sentences(key: np.ndarray, target: np.ndarray, vocabulary: str) -> pa.Array:
    """Texts of a few rows: one row of draws each, written up to the first sentence end behind the target."""
    lengths, written = _vocabulary_tables(vocabulary)
    longest = max(int(target.max()), 0)
    # A little more draws than words of mean length need, then as many as the shortest words do.
    for most in (int(1.05 * longest / lengths.mean()) + 2 * LONGEST, longest // int(lengths.min()) + 1 + LONGEST):
        j = np.arange(1, most + 1)
        x = _folded(key[:, None] + j * 104_729)
        x = _folded(x * x + key[:, None])
        x = _folded(x * x + 104_729)
        x -= PRIME * (x >= PRIME)
        rest = x // len(lengths)
        word = x - rest * len(lengths)
        turn = rest // SENTENCE
        ends = (rest == turn * SENTENCE) | (j % LONGEST == 0)
        stops = ends & (np.cumsum(lengths[word], axis=1) >= target[:, None])
        if stops.any(axis=1).all():
            break
    n = stops.argmax(axis=1) + 1
    form = word * 2
    form[:, 0] += 1
    form[:, 1:] += ends[:, :-1]
    form = form * (1 + len(MARKS)) + np.where(ends, turn % len(MARKS) + 1, 0)
    shown = written.take(pa.array(form[j <= n[:, None]]))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), shown), " ")


def value(attempt: Column, seed: int, target: Column, vocabulary: str = WORDS) -> Column:
    """Sentences of drawn words until their bytes reach ``target``.

    A draw counts up from the key and squares twice; it gives a word and whether a sentence ends with it, and
    none is longer than LONGEST words.  The blanks between sentences are not counted, so each word takes its
    bytes and one more, for a blank or a mark: the number of words follows from a table of word lengths
    before any text is made, and each word is written once.
    """
    @F.arrow_udf("string")
    def made(key: pa.Array, target: pa.Array) -> pa.Array:
        there = np.flatnonzero(pc.and_(key.is_valid(), target.is_valid()).to_numpy(zero_copy_only=False))
        keys, targets = (c.take(pa.array(there)).cast(pa.int64()).to_numpy() for c in (key, target))
        texts = [_sentences(keys[i:i + ROWS], targets[i:i + ROWS], vocabulary) for i in range(0, len(there), ROWS)]
        at = np.full(len(key), -1)
        at[there] = np.arange(len(there))
        joined = pa.concat_arrays([pa.array([], pa.string()), *texts])
        return joined if len(there) == len(key) else joined.take(pa.array(at, mask=at < 0))

    return made(_key(attempt, seed, 1), target)


def target_bytes(attempt: Column, seed: int) -> Column:
    return (_key(attempt, seed, 2) % (MAX_VALUE_BYTES - MIN_VALUE_BYTES + 1) + MIN_VALUE_BYTES).cast("int")


def rows_for_size(target_gb: float, avg_value_bytes: int = 8000) -> int:
    """Rows needed for a size: a row is its value, about 20 title bytes and 10 of CSV."""
    return int(target_gb * 1024 ** 3 / (20 + avg_value_bytes + 10))


def unique_titles(block: Callable[[int], DataFrame], num_rows: int, seed: int,
                  templates: list[str] = FULL_TEMPLATES, vocabulary: str = WORDS) -> DataFrame:
    """The first ``num_rows`` attempts with a new title: ``(attempt, title)``, slim rows.

    ``block(i)`` gives the i-th block of attempts, in ascending order.  A block is only drawn while
    titles are missing; ATTEMPTS_PER_ROW of them at most.
    """
    drawn = None
    for i in range(ATTEMPTS_PER_ROW):
        titles = materialise(block(i).select("attempt", title(F.col("attempt"), seed, templates, vocabulary).alias("title")), "titles")
        drawn = titles if drawn is None else drawn.unionByName(titles)
        unique = distinct_first(drawn, "attempt")
        if unique.count() >= num_rows:
            break
    return first_n(unique, num_rows, "attempt")


def from_attempts(block: Callable[[int], DataFrame], num_rows: int, seed: int = 0,
                  templates: list[str] = FULL_TEMPLATES, vocabulary: str = WORDS) -> DataFrame:
    """The first ``num_rows`` unique titles of blocks of ``attempt`` numbers, with values.

    Titles are drawn, made unique and limited as slim rows; values are made for winners only.
    """
    winners = unique_titles(block, num_rows, seed, templates, vocabulary)
    # Slim rows grow to full ones: spread them by the size they will have.
    spark = winners.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, num_rows * MEAN_ROW_BYTES // PARTITION_BYTES)
    attempt = F.col("attempt")
    return winners.repartition(parts, "attempt").select(
        "title", value(attempt, seed, target_bytes(attempt, seed), vocabulary).alias("value"), attempt.alias("ord"))


def frequent_words(texts: DataFrame, size: int = 2048) -> str:
    """A vocabulary from a ``text`` column: its ``size`` most frequent words of three letters and more,
    ties in their order.  The words of all texts are counted; the result is bounded by ``size``."""
    words = texts.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")).alias("w"))
    top = (words.filter(F.length("w") >= 3).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "w").limit(size).collect())
    return " ".join(r.w for r in top) or WORDS


def generate(spark: SparkSession, *, num_rows: int | None = None, target_gb: float | None = None,
             seed: int = 0, sort: bool = True, templates: list[str] = FULL_TEMPLATES) -> DataFrame:
    """A synthetic dictionary of a row count or a size, sorted unless ``sort=False``."""
    if (num_rows is None) == (target_gb is None):
        raise ValueError("give exactly one of num_rows and target_gb")
    if num_rows is None:
        num_rows = rows_for_size(target_gb)

    def block(i: int) -> DataFrame:
        return spark.range(i * num_rows, (i + 1) * num_rows).select(F.col("id").alias("attempt"))

    rows = from_attempts(block, num_rows, seed, templates)
    made = rows.select("ord").count()
    if made < num_rows:
        warnings.warn(f"only {made} unique titles of {num_rows} requested", stacklevel=2)
    return stable_sort(rows).drop("k") if sort else rows
