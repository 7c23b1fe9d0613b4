"""Hierarchical class labels: vocabulary, dialects, common ancestors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the controlled vocabulary.
PATHS = (
    "Mobile_element",
    "Class_I",
    "Class_I/DIRS",
    "Class_I/LINE",
    "Class_I/LTR",
    "Class_I/LTR/Ty1_copia",
    "Class_I/LTR/Ty1_copia/Ale",
    "Class_I/LTR/Ty1_copia/Alesia",
    "Class_I/LTR/Ty1_copia/Alexandra",
    "Class_I/LTR/Ty1_copia/Angela",
    "Class_I/LTR/Ty1_copia/Bianca",
    "Class_I/LTR/Ty1_copia/Bryana",
    "Class_I/LTR/Ty1_copia/Bryco",
    "Class_I/LTR/Ty1_copia/Ferco",
    "Class_I/LTR/Ty1_copia/Gymco-I",
    "Class_I/LTR/Ty1_copia/Gymco-II",
    "Class_I/LTR/Ty1_copia/Gymco-III",
    "Class_I/LTR/Ty1_copia/Gymco-IV",
    "Class_I/LTR/Ty1_copia/Ikeros",
    "Class_I/LTR/Ty1_copia/Ivana",
    "Class_I/LTR/Ty1_copia/Lyco",
    "Class_I/LTR/Ty1_copia/Osser",
    "Class_I/LTR/Ty1_copia/SIRE",
    "Class_I/LTR/Ty1_copia/TAR",
    "Class_I/LTR/Ty1_copia/Tork",
    "Class_I/LTR/Ty1_copia/Ty1-outgroup",
    "Class_I/LTR/Ty3_gypsy",
    "Class_I/LTR/Ty3_gypsy/chromovirus",
    "Class_I/LTR/Ty3_gypsy/chromovirus/Chlamyvir",
    "Class_I/LTR/Ty3_gypsy/chromovirus/chromo-outgroup",
    "Class_I/LTR/Ty3_gypsy/chromovirus/chromo-unclass",
    "Class_I/LTR/Ty3_gypsy/chromovirus/CRM",
    "Class_I/LTR/Ty3_gypsy/chromovirus/Ferney",
    "Class_I/LTR/Ty3_gypsy/chromovirus/Galadriel",
    "Class_I/LTR/Ty3_gypsy/chromovirus/Reina",
    "Class_I/LTR/Ty3_gypsy/chromovirus/Tcn1",
    "Class_I/LTR/Ty3_gypsy/chromovirus/Tekay",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/non-chromo-outgroup",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA/Athila",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA/Tat",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA/Tat/Ogre",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA/Tat/Retand",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA/Tat/TatI",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA/Tat/TatII",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA/Tat/TatIII",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/OTA/Tatius",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/Phygy",
    "Class_I/LTR/Ty3_gypsy/non-chromovirus/Selgy",
    "Class_I/pararetrovirus",
    "Class_I/Penelope",
    "Class_I/SINE",
    "Class_II",
    "Class_II/Subclass_1",
    "Class_II/Subclass_1/TIR",
    "Class_II/Subclass_1/TIR/EnSpm_CACTA",
    "Class_II/Subclass_1/TIR/hAT",
    "Class_II/Subclass_1/TIR/Kolobok",
    "Class_II/Subclass_1/TIR/Merlin",
    "Class_II/Subclass_1/TIR/MITE",
    "Class_II/Subclass_1/TIR/MITE/Stowaway",
    "Class_II/Subclass_1/TIR/MuDR_Mutator",
    "Class_II/Subclass_1/TIR/Novosib",
    "Class_II/Subclass_1/TIR/P",
    "Class_II/Subclass_1/TIR/PIF_Harbinger",
    "Class_II/Subclass_1/TIR/PiggyBac",
    "Class_II/Subclass_1/TIR/Sola1",
    "Class_II/Subclass_1/TIR/Sola2",
    "Class_II/Subclass_1/TIR/Tc1_Mariner",
    "Class_II/Subclass_2",
    "Class_II/Subclass_2/Helitron",
    "rDNA",
    "rDNA/45S_rDNA",
    "rDNA/45S_rDNA/18S",
    "rDNA/45S_rDNA/25S",
    "rDNA/45S_rDNA/5.8S",
    "rDNA/45S_rDNA/IGS",
    "rDNA/45S_rDNA/ITS1",
    "rDNA/45S_rDNA/ITS2",
    "rDNA/5S_rDNA",
    "rDNA/5S_rDNA/5S",
)
ALIASES = {"Ty1/copia": "Ty1_copia", "Ty3/gypsy": "Ty3_gypsy", "EnSpm/CACTA": "EnSpm_CACTA", "MuDR/Mutator": "MuDR_Mutator", "PIF/Harbinger": "PIF_Harbinger", "Tc1/Mariner": "Tc1_Mariner"}
SPECIAL = ("Satellite", "Simple_repeat", "Low_complexity", "Unknown")
UNDERSCORED = (
    ("Class_II_Subclass_1_TIR_", "Class_II/Subclass_1/TIR/"),
    ("Class_II_Subclass_2_TIR_", "Class_II/Subclass_2/TIR/"),
    ("Class_II/Subclass_1/TIR_", "Class_II/Subclass_1/TIR/"),
    ("Class_II/Subclass_2/TIR_", "Class_II/Subclass_2/TIR/"),
    ("Class_II_Subclass_1_", "Class_II/Subclass_1/"),
    ("Class_II_Subclass_2_", "Class_II/Subclass_2/"),
)
BUCKETS = ("Mobile_elements", "Simple_repeats", "Tandem_repeats", "All_Ty1_Copia", "All_Ty3_Gypsy")
# End of fixed values.


@dataclass(frozen=True)
class Vocabulary:
    """Class paths, special classes and buckets, aliases of path parts, and prefixes of the underscore dialect (longest first)."""

    paths: tuple[str, ...]
    special: tuple[str, ...] = SPECIAL
    buckets: tuple[str, ...] = BUCKETS
    aliases: tuple[tuple[str, str], ...] = tuple(ALIASES.items())
    prefixes: tuple[tuple[str, str], ...] = UNDERSCORED


STANDARD = Vocabulary(PATHS)
# The sources by dialect.
PIPED = ("DANTE", "DANTE_LTR", "DANTE_LINE")
PREFIXED = ("DANTE_TIR",)
PLAIN = ("DANTE_TIR_FALLBACK", "RepeatMasker", "TideCluster", "custom_library")
# End of fixed values.


def without_similarity(label: Column) -> Column:
    """Drop a similarity suffix such as `` (87%25)``."""
    return F.regexp_replace(label, r"\s*\([0-9]+(?:\.[0-9]+)?%25\)$", "")


def canon_piped(label: Column, vocab: Vocabulary = STANDARD) -> Column:
    """Pipe-separated dialect: parts trimmed, empty ones dropped, aliases applied, joined by '/'."""
    parts = F.filter(F.transform(F.split(label, r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    if vocab.aliases:
        aliases = F.create_map(*[F.lit(x) for pair in vocab.aliases for x in pair])
        parts = F.transform(parts, lambda p: F.coalesce(F.try_element_at(aliases, p), p))
    return F.array_join(parts, "/")


def _underscored(label: Column, vocab: Vocabulary) -> Column:
    test = F.lit(False)
    for flat, _ in vocab.prefixes:
        test = test | label.startswith(flat)
    return test


def canon_underscored(label: Column, vocab: Vocabulary = STANDARD) -> Column:
    """Underscore dialect: the longest known prefix becomes a path, the leaf stays."""
    out = F.when(F.lit(False), label)
    for flat, path in vocab.prefixes:
        out = out.when(label.startswith(flat), F.concat(F.lit(path), F.substring(label, len(flat) + 1, 1 << 20)))
    return out.otherwise(label)


def is_canonical(label: Column, vocab: Vocabulary = STANDARD) -> Column:
    """In the vocabulary, a bucket or a special class; Satellite takes any non-empty sub-path."""
    known = label.isin(*vocab.paths, *vocab.special, *vocab.buckets)
    return F.coalesce(known | (label.startswith("Satellite/") & (F.length(label) > len("Satellite/"))), F.lit(False))


def canonicalise(label: Column, source: Column | None = None, vocab: Vocabulary = STANDARD) -> Column:
    """The path of a label in the dialect of its source, or of the dialect it shows where source is null.

    Null for null and empty labels and unknown sources.
    """
    label = F.trim(without_similarity(F.trim(label)))
    seen = F.when(label.contains("|"), canon_piped(label, vocab)).when(_underscored(label, vocab), canon_underscored(label, vocab)).otherwise(label)
    out = seen
    if source is not None:
        out = F.when(source.isNull(), seen).when(source.isin(*PIPED), canon_piped(label, vocab)).when(source.isin(*PREFIXED), canon_underscored(label, vocab))
        out = out.when(source.isin(*PLAIN), label)
    return F.when(F.coalesce(label, F.lit("")) != "", out)


def failure(label: Column, source: Column | None = None, vocab: Vocabulary = STANDARD) -> Column:
    """Why a label has no canonical path: null, empty, unknown source or not canonical; null where it has one."""
    unknown = F.lit(False) if source is None else source.isNotNull() & ~source.isin(*PIPED, *PREFIXED, *PLAIN)
    out = F.when(label.isNull(), "null").when(F.trim(label) == "", "empty").when(unknown, "unknown source")
    return out.when(~is_canonical(canonicalise(label, source, vocab), vocab), "not canonical")


def canonical_or_error(label: Column, source: Column | None = None, vocab: Vocabulary = STANDARD) -> Column:
    """The canonical path; a label without one stops the job."""
    why = failure(label, source, vocab)
    error = F.raise_error(F.concat(F.lit("no canonical class: "), F.coalesce(label, F.lit("null")), F.lit(", "), why))
    return F.when(why.isNull(), canonicalise(label, source, vocab)).otherwise(error.cast("string"))


def lca_prefix(paths: Column) -> Column:
    """Longest common path prefix of an array of labels; Unknown where there is none.

    The common prefix of all paths is that of the smallest and the largest one.
    """
    split = F.transform(paths, lambda p: F.split(p, "/"))
    low, high = F.array_min(split), F.array_max(split)
    same = F.zip_with(low, high, lambda a, b: F.coalesce(a == b, F.lit(False)))
    n = F.array_position(same, F.lit(False)).cast("int")
    n = F.when(n == 0, F.size(same)).otherwise(n - 1)
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.array_join(F.slice(low, F.lit(1), n), "/")).otherwise(F.lit("Unknown"))


def lca_positional(paths: Column) -> Column:
    """The first path cut at the largest position at which all paths agree; Unknown where none agrees."""
    split = F.transform(paths, lambda p: F.split(p, "/"))
    first = split[0]
    agree = F.transform(first, lambda part, i: F.forall(split, lambda p: F.coalesce(F.get(p, i) == part, F.lit(False))))
    last = F.array_max(F.filter(F.sequence(F.lit(1), F.size(first)), lambda k: F.get(agree, k - 1)))
    return F.when(last.isNotNull(), F.array_join(F.slice(first, F.lit(1), F.coalesce(last, F.lit(1))), "/")).otherwise(F.lit("Unknown"))


def is_compatible(a: Column, b: Column) -> Column:
    """Equal paths, or one an ancestor of the other."""
    return (a == b) | a.startswith(F.concat(b, F.lit("/"))) | b.startswith(F.concat(a, F.lit("/")))


def ancestors(label: Column) -> Column:
    """All prefixes of a path, itself included."""
    parts = F.split(label, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def feature_type(label: Column) -> Column:
    return F.when(label.rlike("^(Satellite|Simple_repeat|Low_complexity|rDNA|Unknown)"), "repeat_region").otherwise("transposable_element")


def completeness(identifier: Column) -> Column:
    return F.when(identifier.rlike("^TE_partial_"), "partial").otherwise("complete")


def complete_rank(rank: Column) -> Column:
    """Elements with domains and terminal repeats; rows of a table without ranks pass as null does not."""
    return F.coalesce(rank.isin("DL", "DLT", "DLP", "DLTP"), F.lit(False))


def tir_subtype(name: Column, classification: Column, quality: Column) -> Column:
    """Last part of the piped class of a good TPase domain of Subclass_1 with at least four parts, else null."""
    parts = F.split(classification, r"\|")
    good = (name == "TPase") & classification.contains("Subclass_1") & quality & (F.size(parts) >= 4)
    return F.when(good & (F.element_at(parts, -1) != ""), F.element_at(parts, -1))


# Bar categories and the label patterns that select them, later ones first.
CATEGORIES = (
    ("^Unknown", "Unknown"),
    ("^Low_complexity", "Low complexity"),
    ("^Simple_repeat", "Simple repeats"),
    ("^rDNA", "rDNA"),
    ("^Satellite", "Tandem_repeats"),
    ("^Class_II", "Class II"),
    ("pararetrovirus", "Pararetrovirus"),
    ("Class_I/LINE", "LINE"),
    ("Ty3_gypsy", "Ty3/gypsy"),
    ("Ty1_copia", "Ty1/copia"),
)
# End of fixed values.


def repeat_category(label: Column) -> Column:
    """Category of the composition bars."""
    out = F.when(F.lit(False), "")
    for pattern, category in CATEGORIES:
        out = out.when(label.rlike(pattern), category)
    return out.otherwise("Other repeats")


def sanitised(label: Column) -> Column:
    """File-safe label: other characters become '_', none at the ends."""
    return F.regexp_replace(F.regexp_replace(label, r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", "")


def good_domain(identity: Column, similarity: Column, length: Column, interruptions: Column) -> Column:
    """Quality rule for protein domains; missing or non-numeric values fail."""
    values = [c.cast("string").try_cast("double") for c in (identity, similarity, length, interruptions)]
    i, s, n, r = values
    real = ~(F.isnan(i) | F.isnan(s) | F.isnan(n) | F.isnan(r))
    return F.coalesce(real & (i >= 0.35) & (s >= 0.45) & (r <= 3) & n.between(0.8, 1.2), F.lit(False))


def group_id(label: Column, number: Column) -> Column:
    """Id of the ``number``-th fallback element of a subtype."""
    return F.concat_ws("_", sanitised(label), number.cast("string"), F.lit("partial"))


def anchor_score(similarity: Column, length: Column) -> Column:
    """How good an anchor a domain is: similarity times relative length, 0 where either is missing."""
    return F.coalesce(similarity, F.lit(0)) * F.coalesce(length, F.lit(0))
