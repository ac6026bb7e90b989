"""Answers of a language model as typed rows, and the prompts that ask for them. Models are not called; answers are a snapshot table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("revenue_msek", "ebit_msek", "employees", "ceo", "fiscal_year")
FIELDS_EBIT = ("ebit_msek", "revenue_msek")
FIELDS_PEOPLE = ("employees", "ceo")
#: The text that a prompt may take.
EXCERPT = 72_000


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.variant_get(v, path, "variant"))


def parse_answers(answers: DataFrame, text: str = "answer", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """A row for each answer and field: ``value_num`` or ``value_str``, ``page`` (whole, from 1), ``source_quote``, ``unit_stated``, ``reporting_scope``, ``normalization`` (its strings).

    Values of another type become null, as do fields that are absent; an answer that is no JSON, or null, gives no rows. The other columns are kept.
    """
    rows = answers.withColumn("_v", F.try_parse_json(text)).where(F.col("_v").isNotNull() & ~F.is_variant_null("_v"))
    v = F.col("_v")

    def string(path: str) -> Column:
        return F.when(_kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))

    def number(path: str) -> Column:
        return F.when(_kind(v, path).rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.try_variant_get(v, path, "double"))

    def pick(f: str) -> Column:
        page = number(f"$.{f}.page")
        items = F.try_variant_get(v, f"$.{f}.normalization", "array<variant>")
        words = F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
        return F.struct(
            F.lit(f).alias("field"),
            number(f"$.{f}.value").alias("value_num"),
            string(f"$.{f}.value").alias("value_str"),
            F.when(page >= 1, F.floor(page).cast("int")).alias("page"),
            *(string(f"$.{f}.{k}").alias(k) for k in ("source_quote", "unit_stated", "reporting_scope")),
            F.coalesce(words, F.array().cast("array<string>")).alias("normalization"),
        )

    kept = [c for c in answers.columns if c != text]
    return rows.select(*kept, F.explode(F.array(*map(pick, fields))).alias("_f")).select(*kept, "_f.*")


def attach(rows: DataFrame, answers: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows with their answers' fields, one row each; documents without an answer have null ones."""
    return rows.join(answers, key, "left")


def prompt(company: Column, fields: tuple[str, ...], text: Column) -> Column:
    """The question for a document: the company, the fields by name, how to answer, and the text's first characters."""
    ask = ", ".join(fields)
    form = '{"<field>": {"value": number|string|null, "page": number|null, "source_quote": string|null, "unit_stated": string|null, "reporting_scope": string|null, "normalization": []}}'
    return F.concat(
        F.lit("Company: "),
        company,
        F.lit(f"\nFields: {ask}\nTake consolidated figures of the latest full year. Quote the source word for word. Leave out what is not stated.\nAnswer with one JSON object of the form {form}\n\nDocument:\n"),
        F.substring(F.coalesce(text, F.lit("")), 1, EXCERPT),
    )
