"""Scalar rules on variant fields, as Spark Column expressions (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from variantloom.names import (
    CHROMOSOME_RANKS,
    CLINVAR_LABELS,
    EFFECT_ORDER,
    GENE_URL,
    MISSING,
    RSID_URL,
)

# Java reads "1d" and "1f" as numbers; a variant file does not.
JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"


def quoted(name: str) -> str:
    """Exact column name for SQL text; variant column names may contain dots and blanks."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """Text as a SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def col(name: str) -> Column:
    return F.col(quoted(name))


def default_ranks() -> dict[str, int]:
    return {effect: i for i, effect in enumerate(EFFECT_ORDER, start=1)}


def effect_term(annotation: Column) -> Column:
    """First `&`-part of an effect."""
    return F.nullif(F.substring_index(annotation, "&", 1), F.lit(""))


def term_rank(term: Column, ranks: Mapping[str, int] | None = None) -> Column:
    """Severity rank of an effect term; NULL if it is unknown."""
    table = default_ranks() if ranks is None else ranks
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[term]


def effect_rank(annotation: Column, ranks: Mapping[str, int] | None = None) -> Column:
    return term_rank(effect_term(annotation), ranks)


def severity_order(allele: Column, alt: Column, term: Column, rank: Column) -> Column:
    """Sortable struct: own allele first, then rank, then unknown terms by text, missing last."""
    unranked = F.when(term.isNull(), F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    return F.struct(
        (~allele.eqNullSafe(alt)).alias("foreign"),
        F.coalesce(rank.cast("double"), unranked).alias("rank"),
        F.when(rank.isNull(), term).alias("term"),
    )


def clean_hgvs_c(hgvs: Column) -> Column:
    return F.when(~hgvs.contains("null"), hgvs)


def amino_change(hgvs_p: Column) -> Column:
    """"CHANGE" when the first and last residue differ, else "."."""
    bare = F.replace(hgvs_p, F.lit("p."), F.lit(""))
    changed = F.substring(bare, 1, 3) != F.right(bare, F.lit(3))
    return F.when(changed, F.lit("CHANGE")).otherwise(F.lit(MISSING))


def zygosity(is_hom: Column) -> Column:
    return F.when(is_hom, F.lit("HOM")).otherwise(F.lit("HET"))


def number(value: Column) -> Column:
    """Text as a number; anything else becomes NULL."""
    parsed = F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))
    return F.when(~value.rlike(JAVA_SUFFIX), parsed)


def to_double(value: Column) -> Column:
    """Number rounded to 6 places; anything that is not a number becomes NULL."""
    return F.round(number(value), 6)


def to_integer(value: Column) -> Column:
    return F.trim(value).try_cast("bigint")


def esp_frequency(maf: Column, position: int) -> Column:
    """One of the comma-separated percentages as a fraction."""
    part = F.get(F.split(maf, ","), F.lit(position))
    return F.round(number(part) / F.lit(100.0), 6)


def polyphen_prediction(value: Column) -> Column:
    return F.nullif(F.btrim(F.substring_index(value, ":", 1), F.lit(".,")), F.lit(""))


def polyphen_score(value: Column) -> Column:
    after = F.get(F.split(value, ":", 2), F.lit(1))
    return F.nullif(F.substring_index(after, ",", 1), F.lit(""))


def clinvar_labels(codes: Column) -> Column:
    """Significance codes as text; separators between several codes stay."""
    return reduce(
        lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])),
        CLINVAR_LABELS.items(),
        codes,
    )


def dosage(zigosity: Column) -> Column:
    """Number of alternate alleles a genotype label stands for (unknown = 0)."""
    hom = F.when(zigosity.contains("HOM"), 2).otherwise(0)
    het = F.when(zigosity.contains("HET"), 1).otherwise(0)
    return hom + het


def chromosome_rank(chrom: Column) -> Column:
    """Numeric order of chromosomes with the sex chromosomes after the autosomes."""
    bare = F.regexp_replace(chrom, "^chr", "")
    rank = F.coalesce(
        *[F.when(bare == name, F.lit(place)) for name, place in CHROMOSOME_RANKS.items()],
        bare.try_cast("int"),
    )
    return rank


def first_rsid(rsid: Column) -> Column:
    """First identifier that starts with "rs" or is a plain number, else "."."""
    tokens = F.split(rsid, "[;,]")
    known = F.filter(tokens, lambda t: t.rlike("^(rs.*|[0-9]+)$"))
    return F.when(rsid.isNotNull(), F.coalesce(F.get(known, F.lit(0)), F.lit(MISSING)))


def leading_rsid(rsid: Column) -> Column:
    """First identifier whatever its form."""
    return F.get(F.split(rsid, "[;,]"), F.lit(0))


def rsid_link(identifier: Column) -> Column:
    return F.concat(F.lit(RSID_URL), identifier)


def gene_link(gene: Column) -> Column:
    return F.concat(F.lit(GENE_URL), gene)


def sample_base(sample: Column, suffix: str) -> Column:
    """Sample name before the processing suffix."""
    return F.substring_index(sample, suffix, 1) if suffix else sample


def table_safe(sample: Column) -> Column:
    return F.lower(F.replace(sample, F.lit("-"), F.lit("_")))


def export_text(value: Column) -> Column:
    """Text form of an export cell: missing and empty cells become "."."""
    text = F.nullif(F.nullif(value.cast("string"), F.lit("")), F.lit("nan"))
    return F.coalesce(text, F.lit(MISSING))
