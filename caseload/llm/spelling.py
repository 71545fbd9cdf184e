"""Groups of spelling variants: words one letter apart from a much more frequent word, by a variable-length gram index.

Words are joined with the words at edit distance one (one letter inserted, deleted or replaced) as follows. A word is
read as ``^word$`` with as many ``$`` as the longest gram has letters.

* **Dictionary.** Grams of the lengths in ``LADDER`` that stand at more than ``FREQUENT`` places of the distinct words. Only
  such a gram is extended to the next length, so the gram at a place is the shortest infrequent one (or the longest of
  the ladder). It depends on nothing but its own letters. Half a word bounds a gram's length: the bound belongs to the length
  of the words of a list, not to the word that looks something up.
* **Index.** The gram at every place of every word, in lists by gram, place and length of the word.
* **Affected grams.** One edit affects the grams over it and no other, so of two grams that do not overlap it leaves one, and
  with it the place from the word's start (the left gram) or from its end (the right gram). For each word, and for
  each length of the partner (its own or one less), the two are chosen whose lists are shortest together; every
  partner is in one of them. Half-length grams always give a pair.
* **Verification** by the edit distance itself, inside the join.

A list is read by the words that chose it. Its length is bounded by the words of one length that agree in a gram at one place;
hot ones are split by the skew handling of equi-joins, as no row needs its list as a whole.

A word's *form* is its near word of largest count (ties: the first in code-point order), if that is at least
``DOMINANCE`` times its own count. Counts grow along forms, so following them ends; its end is the word's *root*. Roots are found by
pointer doubling over tables in the shared folder.

Null and empty texts have no words; a run of letters may have any length; rows that repeat a doc_id are counted as they are. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.storage import stored

#: A run of letters.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Letters and occurrences of a word that is looked at, and how much more frequent its form must be.
MIN_LETTERS = 6
MIN_COUNT = 5
DOMINANCE = 5
#: Lengths of grams, and the number of places beyond which a gram is extended.
LADDER = (3, 4, 5, 6, 8, 12)
FREQUENT = 500


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT, rewrite: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(word, n): the runs of letters of all texts with A-Z lower-cased, counted. ``rewrite(id, word)`` may change a run first."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), *LOWER), F.lit(LETTERS), F.lit(0))
    words = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("word")).where(F.length("word") >= min_letters)
    if rewrite:
        words = words.select(rewrite(F.col("id"), F.col("word")).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.where((F.length("word") >= min_letters) & (F.col("n") >= min_count))


def _gram(letters: Column | int) -> Column:
    """The gram at a row's place."""
    return F.col("padded").substr(F.col("at") + 1, F.lit(letters) if isinstance(letters, int) else letters)


def frequent_grams(places: DataFrame, ladder: tuple[int, ...], frequent: int) -> DataFrame:
    """The grams (column gram) of the ladder's lengths but the last that stand at more than ``frequent`` places."""
    grams = places.select(F.explode(F.array(*[_gram(q) for q in ladder[:-1]])).alias("gram"))
    return grams.groupBy("gram").count().where(F.col("count") > frequent).select("gram")


def decompose(places: DataFrame, dictionary: DataFrame, ladder: tuple[int, ...]) -> DataFrame:
    """``places`` with ``size``, the letters of the gram there: the first length of the ladder at which it is infrequent."""
    size = F.lit(ladder[-1])
    for q in reversed(ladder[:-1]):
        known = dictionary.where(F.length("gram") == q).select(F.col("gram").alias(f"gram{q}"))
        places = places.join(known, _gram(q) == F.col(f"gram{q}"), "left")
        size = F.when(F.col(f"gram{q}").isNull(), q).otherwise(size)
    return places.select("word", "n", "padded", "letters", "at", size.cast("int").alias("size"))


def _list_key(letters: Column, shift: int, ladder: tuple[int, ...]) -> tuple[Column, Column]:
    """The list of the gram at a place among words of ``letters`` letters, where it stands ``shift`` further right, and the gram's length."""
    half = F.floor((letters + 2) / 2)
    most = reduce(lambda rest, q: F.when((half >= q) & (F.col("size") >= q), q).otherwise(rest), ladder[1:], F.lit(ladder[0]))
    # The longest step of the ladder within the half and the gram: later steps overrule earlier ones.
    return F.xxhash64(_gram(most), F.col("at") + shift, letters), most.cast("int")


def _cheapest(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each word and partner length (rows together, by place) the keys of two grams that do not overlap, with the shortest lists."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        word, target = batch["word"].to_numpy(), batch["target"].to_numpy()
        same = (word == word[-1]) & (target == target[-1])
        cut = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if cut or (held and (held[-1]["word"].iloc[-1], held[-1]["target"].iloc[-1]) != (word[0], target[0])):
            yield _chosen(pd.concat([*held, batch.iloc[:cut]]))
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield _chosen(pd.concat(held))


def _chosen(rows: pd.DataFrame) -> pd.DataFrame:
    word, target = rows["word"].to_numpy(), rows["target"].to_numpy()
    begins = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (target[1:] != target[:-1])]) if len(rows) else np.zeros(0, np.int64)
    at, end = rows["at"].tolist(), rows["end"].tolist()
    left_size, right_size = rows["left_size"].tolist(), rows["right_size"].tolist()
    picked: list[int] = []
    sides: list[bool] = []
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(rows)]):
        # The shortest list of a gram that begins at or after each place, from the right.
        best_right = [0] * (b - a)
        for k in range(b - 1, a - 1, -1):
            best_right[k - a] = k if k == b - 1 or right_size[k] < right_size[best_right[k - a + 1]] else best_right[k - a + 1]
        choice, cost = None, 0
        for k in range(a, b):
            after = a + end[k] - at[a]  # places are consecutive
            if after < b and (choice is None or left_size[k] + right_size[best_right[after - a]] < cost):
                choice = k, best_right[after - a]
                cost = left_size[k] + right_size[choice[1]]
        picked += choice
        sides += [True, False]
    at_left = np.array(sides, bool)
    out = rows.iloc[picked]
    sizes = np.where(at_left, out["left_size"], out["right_size"])
    out = pd.DataFrame({"word": out["word"], "n": out["n"], "target": out["target"],
                        "key": np.where(at_left, out["left_key"], out["right_key"]).astype(np.int64)})
    return out[sizes > 0].drop_duplicates(["word", "target", "key"])


def near_pairs(words: DataFrame, ladder: tuple[int, ...] = LADDER, frequent: int = FREQUENT) -> DataFrame:
    """(word, n, other, other_n): the pairs of the distinct ``words`` (word, n) at edit distance one, each pair once.

    A word needs at least twice the letters of the shortest gram, less two, so that two grams fit.
    """
    shortest = 2 * ladder[0] - 2
    tail = F.lit("$" * ladder[-1])
    # The words are few bytes, but each becomes some fifty rows: dealt out over all tasks first.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = words.repartition(tasks, "word").select("word", "n", F.concat(F.lit("^"), "word", tail).alias("padded"), F.length("word").alias("letters"))
    # Where a gram of at least the shortest length still holds a letter or the first end mark.
    places = places.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("letters") + 2 - ladder[0])))
    dictionary = stored(frequent_grams(places, ladder, frequent), "gram-dictionary")
    placed = stored(decompose(places, dictionary, ladder), "word-grams")
    own, own_size = _list_key(F.col("letters"), 0, ladder)
    index = placed.select("word", "n", "letters", own.alias("key"))
    index = stored(index, "gram-lists")
    sizes = index.groupBy("key").agg(F.count("*").alias("size"))

    less = F.col("letters") - 1
    at_left, left_size = _list_key(less, 0, ladder)
    at_right, _ = _list_key(less, -1, ladder)
    offers = placed.select("word", "n", "letters", "at", F.explode(F.array(
        F.struct(F.col("letters").alias("target"), (F.col("at") + own_size).alias("end"), own.alias("left_key"), own.alias("right_key")),
        F.struct(less.alias("target"), (F.col("at") + left_size).alias("end"), at_left.alias("left_key"), at_right.alias("right_key")),
    )).alias("o")).select("word", "n", "at", "o.*").where(F.col("target") >= shortest)
    left = sizes.select(F.col("key").alias("left_key"), F.col("size").alias("left_size"))
    right = sizes.select(F.col("key").alias("right_key"), F.col("size").alias("right_size"))
    offers = (offers.join(left, "left_key", "left").join(right, "right_key", "left")
              .fillna(0, ["left_size", "right_size"]).repartition("word", "target").sortWithinPartitions("word", "target", "at"))
    kinds = dict(words.dtypes)
    probes = stored(offers.mapInPandas(_cheapest, f"word string, n {kinds['n']}, target int, key long"), "gram-probes")

    listed = index.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("letters").alias("target"), "key")
    # Equally long partners find one another from both sides; one of them is enough.
    wanted = ((F.length("word") > F.col("target")) | (F.col("word") > F.col("other"))) & (F.levenshtein("word", "other", 1) == 1)
    return probes.join(listed, ["key", "target"]).where(wanted).select("word", "n", "other", "other_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where each word of ``forms`` (word, form) ends when forms are followed; they must not go in circles."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                              F.col("further").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                      min_count: int = MIN_COUNT, dominance: int = DOMINANCE,
                      rewrite: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """One row per distinct word: word, n, n_near, form, form_n, root."""
    if min_letters < 2 * LADDER[0] - 2:
        raise ValueError(f"min_letters must be {2 * LADDER[0] - 2} or more, so that two grams fit")
    words = stored(word_counts(docs, id_col, text_col, min_letters, min_count, rewrite), "words")
    pairs = stored(near_pairs(words), "near-words")
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    near = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    near = near.withColumn("form_n", F.when(-F.col("best.n") >= dominance * F.col("n"), -F.col("best.n")))
    near = stored(near.select("word", "n_near", F.when(F.col("form_n").isNotNull(), F.col("best.other")).alias("form"), "form_n"), "forms")
    ends = roots(near.where("form is not null"))
    return (words.join(near, "word", "left").join(ends, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")))
