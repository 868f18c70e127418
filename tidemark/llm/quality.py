"""Quality rules: a table of thresholds compiled into one projection, with built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# Frequent short words of the languages the rules are for (fixed values).
STOP_WORDS = (
    "the of and to in that is was with for on are as be it at by this have from or had not but",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "le la les de des du et en un une que dans pour qui sur est par plus au avec ne se pas",
    "el la los las de que y en un una por con para del se al lo como más su es no",
)
# The same for further languages, for texts that hold too few of the above: without words of one letter, and not counted in n_stop_words.
OTHER_STOP_WORDS = (
    "nie na się do to że jest jak za od po ale tak przez dla przy być który ich już tylko był była oraz",  # Polish
    "ja on ei se että hän oli mutta ovat ole kun niin kuin myös jos sen tai joka mitä vain voi",  # Finnish
    "di che il non per una sono con del della le si dei da alla gli anche più nel ma come",  # Italian
    "de que não para uma com os no se na por mais as dos como mas foi ao ele das tem à seu",  # Portuguese
    "de het een van en in is dat op te zijn met voor niet aan er om ook als door maar bij",  # Dutch
    "och att det som en på är av för med den till inte ett om har de jag men var sig",  # Swedish
    "og at det som en på er af for med den til ikke et om har de jeg men var sig av å",  # Danish, Norwegian
    "na se že je ve za do to jako by ale si po jsem který jsou od pro co tak aby sa nie ako",  # Czech, Slovak
    "az egy és hogy nem is ez volt meg csak de ha mint már kell van el még azt",  # Hungarian
    "și în de la cu nu că pe din este un mai care au fost pentru prin sau ca",  # Romanian
    "bir ve bu için da de ile çok gibi daha ne kadar olarak olan değil ama var sonra",  # Turkish
    "je da se na za su od što koji ali kao ne bi iz nije to sam ili biti bio",  # Croatian, Serbian, Bosnian
    "in je da se na za so ki pa ne bi tudi ali kot od po iz ni še biti",  # Slovenian
    "ir kad tai su yra iš kaip bet ne buvo jis į apie per savo tik dar nuo",  # Lithuanian
    "un ir ka no uz par ar nav bet kas tas lai bija pie viņš jau arī vai",  # Latvian
    "ja on ei ta et see oli ka kui oma mis aga nii ning ma seda siis või kes",  # Estonian
    "yang dan di ini itu dengan untuk tidak dari dalam akan pada ke karena ada juga oleh saya",  # Indonesian, Malay
    "và của là có được cho không một những người trong các này đã với để khi như từ",  # Vietnamese
    "ang ng sa na mga at ay hindi para ito kung ko siya niya mo nang ni",  # Tagalog
    "na ya wa kwa ni katika la za kuwa hii hiyo au yake lakini kama cha",  # Swahili
    "dhe në të një për me nga që është si nuk ka por",  # Albanian
    "og að það er sem ekki var til um við en með hann af því fyrir",  # Icelandic
    "els les amb per que una no és del dels més com però aquest són",  # Catalan
)


@dataclass(frozen=True)
class Threshold:
    """A ratio of two counts, and the range in which it has to be. A ratio over nothing fulfils every range."""

    name: str
    count: str
    of: str
    least: float = 0.0
    most: float = float("inf")


FEW_STOP_WORDS = 0.005
# Lenient on purpose: a rule has to leave clean texts alone.
THRESHOLDS = (
    Threshold("word_length", "word_chars", "n_words", 1.5, 20.0),
    Threshold("symbols", "n_symbols", "n_words", most=0.7),
    Threshold("letters", "n_letters", "word_chars", 0.5),
    Threshold("stop_words", "n_stop_words", "n_words", FEW_STOP_WORDS),
    Threshold("dup_lines", "n_dup_lines", "n_lines", most=0.5),
    Threshold("bullet_lines", "n_bullet_lines", "n_lines", most=0.95),
    Threshold("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=0.6),
)


def _listed(lists: tuple[str, ...]) -> str:
    """An expression for a word of the lists, between what may stand beside it."""
    return r"(?iu)(?<![^\x20\x09-\x0D])(?:" + "|".join(sorted({w for words in lists for w in words.split()})) + r")(?![\p{L}\p{N}])"


def _other_language(text: str, n_words: Column) -> Column:
    """Whether a text is in a language of which STOP_WORDS can tell nothing: no more than half of its letters are Latin ones, or 3 per cent of its
    words are stop words of a further language. Latin texts in a language of neither list are judged like those of STOP_WORDS."""
    letters, latin = F.regexp_count(text, F.lit(r"\p{L}")), F.regexp_count(text, F.lit(r"\p{IsLatin}"))
    # Only texts short of the stop words above are looked at again.
    few = F.col("n_stop_words") < n_words * FEW_STOP_WORDS
    further = [F.regexp_count(text, F.lit(_listed((words,)))) >= n_words * 0.03 for words in OTHER_STOP_WORDS]
    found = latin * 2 <= letters
    for one in further:
        found = found | one
    return F.when(few & (n_words > 0), found).otherwise(F.lit(False))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The row as one struct column ``row``, and the counts that the rules compare."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = rows.withColumns(
        {
            "words": F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
            "n_stop_words": F.regexp_count("text", F.lit(_listed(STOP_WORDS))).cast("bigint"),
            "lines": F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    n = F.size("words")
    # Each window of three words as one string; words hold no spaces, so it stands for nothing else.
    windows = F.zip_with(
        F.slice("words", F.lit(1), F.greatest(n - 2, F.lit(0))),
        F.zip_with(F.slice("words", F.lit(2), F.greatest(n - 2, F.lit(0))), F.slice("words", F.lit(3), F.greatest(n - 2, F.lit(0))), lambda b, c: F.concat(b, F.lit(" "), c)),
        lambda a, bc: F.concat(a, F.lit(" "), bc),
    )
    counted = cut.select(
        "row",
        n.cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        F.char_length(F.regexp_replace("text", r"[^\p{L}]+", "")).cast("bigint").alias("n_letters"),
        "n_stop_words",
        _other_language("text", n).alias("other_language"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda line: line.rlike(r"^[\x20\t]*[-*•]"))).cast("bigint").alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda line: line.rlike(r"(?:\.\.\.|…)[\x20\t\r]*$"))).cast("bigint").alias("n_ellipsis_lines"),
        windows.alias("windows"),
    )
    # Only texts in which some window comes twice are sorted: equal windows become neighbours.
    placed = F.sort_array(F.arrays_zip(F.col("windows").alias("window"), F.sequence(F.lit(0), F.size("windows") - 1).alias("place")))
    ordered = counted.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed)).drop("windows")
    others = F.lit(None).cast("struct<window:string,place:int>")
    beside = F.arrays_zip(
        F.col("ordered").alias("own"),
        F.concat(F.array(others), F.slice("ordered", F.lit(1), F.size("ordered") - 1)).alias("before"),
        F.concat(F.slice("ordered", F.lit(2), F.size("ordered") - 1), F.array(others)).alias("after"),
    )
    own = F.filter(beside, lambda w: F.coalesce(w["own"]["window"] == w["before"]["window"], F.lit(False)) | F.coalesce(w["own"]["window"] == w["after"]["window"], F.lit(False)))
    repeated = ordered.withColumn("places", F.transform(own, lambda w: w["own"]["place"]))
    covered = F.array_distinct(F.concat("places", F.transform("places", lambda p: p + 1), F.transform("places", lambda p: p + 2)))
    return repeated.withColumn("n_repeat_words", F.coalesce(F.size(F.when(F.col("places").isNotNull(), covered)), F.lit(0)).cast("bigint")).withColumn(
        "n_repeat_words", F.when(F.col("places").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("n_repeat_words"))
    ).drop("ordered", "places")


def verdict(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> dict[str, Column]:
    """One column per threshold: whether the ratio is in its range."""
    out = {}
    for t in thresholds:
        ratio = F.col(t.count) / F.col(t.of)
        inside = ratio >= t.least if t.most == float("inf") else (ratio >= t.least) & (ratio <= t.most)
        if t.name == "stop_words":
            inside = inside | F.col("other_language")
        out[f"ok_{t.name}"] = F.when(F.col(t.of) > 0, inside).otherwise(True)
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_letters", "n_stop_words", "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_repeat_words")


def judge(docs: DataFrame, text: str = "text", thresholds: tuple[Threshold, ...] = THRESHOLDS, least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """All rows and columns, with the counts, ``base_failed``, ``ok_<threshold>`` and ``kept``; columns of these names are replaced.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated`` per cent of the words in three-word windows that
    come twice or more in the text. ``kept``: not ``base_failed``, and every ratio in its range. A NULL text has no words,
    so it fails. Repeated rows are judged alike; no row depends on another one.
    """
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    judged = measure(docs, text).withColumns({"base_failed": failed, **verdict(thresholds)})
    oks = [f"ok_{t.name}" for t in thresholds]
    kept = ~F.col("base_failed")
    for ok in oks:
        kept = kept & F.col(ok)
    added = [*COUNTS, "base_failed", *oks]
    others = [F.col(f"row.`{c}`") for c in docs.columns if c not in (*added, "kept")]
    return judged.select(*others, *added, kept.alias("kept"))
