"""Schemas, and adapters that give other tables the shape of business records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


SOURCE = _strings("entity_id", "business_name", "business_address", "country")
TRUTH = _strings("source1_entity_id", "matched_entity_ids")
CANDIDATES = _strings("source1_entity_id", "candidate_entity_ids")

#: Accented letters and what they fold to, place by place (fixed values).
ACCENTED, FOLDED = "áàâäãéèêëíìîïóòôöõúùûüçñ", "aaaaaeeeeiiiiooooouuuucn"


def source_of(entity_id: F.Column) -> F.Column:
    """S1, S2 or S3: what stands before the first hyphen of an id."""
    return F.substring_index(entity_id, "-", 1)


def folded_words(text: F.Column) -> F.Column:
    """The ASCII words of a text, lower-case, without accents."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    plain = F.when(F.octet_length(lower) == F.length(lower), lower).otherwise(F.translate(lower, ACCENTED, FOLDED))
    return F.array_remove(F.split(plain, "[^a-z0-9]+"), "")


def document_id(doc_id: F.Column) -> F.Column:
    """A document's id as a record of one of three sources."""
    return F.concat(F.lit("S"), F.pmod(doc_id, F.lit(3)) + 1, F.lit("-"), doc_id)


def document_entities(documents: DataFrame, name_words: int = 6) -> DataFrame:
    """Documents as records of three sources: the first words are the name, all the others the address, the language the country."""
    words = F.col("words")
    return documents.select("doc_id", "lang", folded_words(F.col("text")).alias("words")).select(
        document_id(F.col("doc_id")).alias("entity_id"),
        F.array_join(F.slice(words, 1, name_words), " ").alias("business_name"),
        F.array_join(F.slice(words, name_words + 1, F.greatest(F.size(words), F.lit(1))), " ").alias("business_address"),
        F.coalesce("lang", F.lit("")).alias("country"),
    )


def part_entities(part: DataFrame) -> DataFrame:
    """Parts as records of three sources: few names shared by many records; brand, type and size are the address, the brand the country."""
    return part.select(
        F.concat(F.lit("S"), F.pmod("p_partkey", F.lit(3)) + 1, F.lit("-"), F.col("p_partkey")).alias("entity_id"),
        F.lower("p_name").alias("business_name"),
        F.lower(F.concat_ws(" ", "p_brand", "p_type", F.col("p_size").cast("string"))).alias("business_address"),
        F.coalesce("p_brand", F.lit("")).alias("country"),
    )
