"""Product categories with their English and Persian labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import flag, is_blank, matches
from stallkeep.operators.quality import audit

SOURCE = "SourceCategoryName"


def conformed_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Every category a product uses, with its English label where there is one."""
    used = products.select(F.col("product_category_name").alias(SOURCE)).filter(F.col(SOURCE).isNotNull()).distinct()
    english = translation.select(
        F.col("product_category_name").alias(SOURCE),
        F.col("product_category_name_english").alias("EnglishCategoryName"),
    )
    return used.join(english, SOURCE, "left").withColumn(
        "MissingEnglishTranslationFlag", flag(F.col("EnglishCategoryName").isNull())
    )


def category_profile(category: DataFrame) -> DataFrame:
    return audit(
        category,
        {
            "RowCount": F.count("*"),
            "MissingEnglishTranslations": matches(F.col("MissingEnglishTranslationFlag") == 1),
        },
    )


def missing_translations(category: DataFrame) -> DataFrame:
    return category.filter("MissingEnglishTranslationFlag = 1").orderBy(SOURCE)


def missing_persian() -> F.Column:
    return F.col("PersianCategoryName").isNull() | is_blank("PersianCategoryName")


def localized_categories(category: DataFrame, localization: DataFrame) -> DataFrame:
    """Categories with the Persian label of the seed table and a flag where it is missing."""
    seed = localization.select(SOURCE, "PersianCategoryName")
    return category.join(seed, SOURCE, "left").withColumn(
        "MissingPersianLocalizationFlag", flag(missing_persian())
    )


def localization_profile(category: DataFrame, localization: DataFrame) -> DataFrame:
    """Seed quality: rows, blank names, categories without a seed row, seed rows without a category."""
    seed = localization.select(SOURCE, "PersianCategoryName").withColumn("_seeded", F.lit(1))
    both = category.select(SOURCE, F.lit(1).alias("_used")).join(seed, SOURCE, "full_outer")
    seeded, used = F.col("_seeded").isNotNull(), F.col("_used").isNotNull()
    duplicates = (
        localization.groupBy(SOURCE).agg(F.count("*").alias("_rows")).agg(matches(F.col("_rows") > 1).alias("n"))
    )
    profile = audit(
        both,
        {
            "CategoryRows": matches(used),
            "LocalizationRows": matches(seeded),
            "MissingPersianNames": matches(seeded & missing_persian()),
            "MissingLocalizationRows": matches(used & ~seeded),
            "OrphanLocalizationRows": matches(seeded & ~used),
        },
    )
    rows = F.array(*[F.struct(F.lit(c).alias("Metric"), F.col(c).alias("Value")) for c in profile.columns])
    return profile.select(F.inline(rows)).unionByName(
        duplicates.select(F.lit("DuplicateLocalizationGroups").alias("Metric"), F.col("n").alias("Value"))
    )
