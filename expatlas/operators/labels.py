"""Free text to vocabularies, and reconciliation of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from expatlas.functions.text import person, replace_phrases, scrub_title, tokens
from expatlas.scratch import materialize


def build_documents(df: DataFrame, key: str, cols: list[str], phrases: list[tuple[str, str]]) -> DataFrame:
    """One lower-case text a row, phrases replaced in order."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return df.select(key, replace_phrases(F.lower(text), phrases).alias("text"))


def top_terms(docs: DataFrame, key: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """Vocabulary terms of highest count in each document, joined by bars; null if there are none."""
    hits = docs.select(key, F.explode(tokens(F.col(text))).alias("term")).join(vocabulary.select("term"), "term", "left_semi")
    counts = hits.groupBy(key, "term").agg(F.count("*").alias("n"))
    first = counts.withColumn("_r", F.rank().over(Window.partitionBy(key).orderBy(F.desc("n")))).filter("_r = 1")
    terms = first.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("term")), "|").alias("terms"))
    return docs.select(key).join(terms, key, "left")


def weights(docs: DataFrame, key: str, text: str, sublinear: bool = False, smooth: bool = False, least_docs: int = 1) -> DataFrame:
    """TF-IDF of the tokens, each document of length 1: ``key, term, weight``."""
    counts = docs.select(key, F.explode(tokens(F.lower(text))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))
    counts = materialize(counts, "terms")  # read twice, tokens are split once
    seen = counts.groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") >= least_docs)
    total = docs.agg(F.count("*").alias("_docs"))
    tf = 1 + F.log("n") if sublinear else F.col("n")
    idf = F.log((1 + F.col("_docs")) / (1 + F.col("df"))) + 1 if smooth else F.log2(F.col("_docs") / F.col("df"))
    raw = counts.join(seen, "term").join(F.broadcast(total)).withColumn("_w", tf * idf)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", F.coalesce(F.try_divide("_w", norm), F.lit(0.0)).alias("weight"))


def keywords(docs: DataFrame, key: str, text: str, least: float = 0.25) -> DataFrame:
    """Terms of more than one document and a weight above ``least``, heaviest first."""
    good = weights(docs, key, text, least_docs=2).filter(F.col("weight") > least)
    ordered = F.array_sort(F.collect_list(F.struct((-F.round("weight", 9)).alias("w"), "term")))
    return good.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["term"]), "|").alias("keywords"))


def tfidf_terms(docs: DataFrame, key: str, text: str, least: float = 0.5) -> DataFrame:
    return weights(docs, key, text, sublinear=True, smooth=True).filter(F.col("weight") > least).select("term").distinct()


def normalize_attributes(attributes: DataFrame, key: str, names: list[str]) -> DataFrame:
    """First value of each normalised attribute name, wide."""
    name = F.regexp_replace(F.lower(F.trim("name")), r"[\s-]+", "_")
    return attributes.select(key, name.alias("name"), F.lower(F.trim("value")).alias("value")).groupBy(key).pivot("name", names).agg(F.min("value"))


def map_vocabulary(df: DataFrame, col: str, lookup: DataFrame) -> DataFrame:
    """Replace a column by its term (``raw, term``); ``None`` and unknown values become null."""
    terms = lookup.select(F.col("raw").alias(col), F.nullif("term", F.lit("None")).alias("_term"))
    return df.join(terms, col, "left").withColumn(col, F.col("_term")).select(*df.columns)


def backfill_sex(sex: Column, text: Column) -> Column:
    male, female = text.rlike(r"(?i)\bmale\b"), text.rlike(r"(?i)\bfemale\b")
    return F.coalesce(sex, F.when(male & female, "mixed").when(female, "female").when(male, "male"))


def backfill_keyword(col: Column, text: Column, rules: list[tuple[str, str]]) -> Column:
    """First rule (pattern, term) that the text fulfils, where the column is null."""
    return F.coalesce(col, *[F.when(text.rlike(p), F.lit(t)) for p, t in rules])


def characteristics(parts: list[DataFrame], key: str) -> DataFrame:
    """One wide table of several tables of traits, aligned on their key; a sample missing in one is null there.

    Each side is reduced to a row a key first, so that no repeated key multiplies the others' rows.
    """
    out = None
    for df in parts:
        one = df.groupBy(key).agg(*[F.min(c).alias(c) for c in df.columns if c != key])
        out = one if out is None else out.join(one, key, "full_outer")
    return out


def sample_metadata(catalog: DataFrame, keyword_table: DataFrame, traits: DataFrame) -> DataFrame:
    """Flat sample table: title, contact, organism list, keywords and characteristics."""
    contact = F.try_element_at("contacts", F.lit(1))
    flat = catalog.select("srx", scrub_title(F.col("title")).alias("title"), person(contact["first"], contact["last"], contact["mail"]).alias("contact"), F.array_join("organisms", "|").alias("organisms"))
    return flat.join(keyword_table, "srx", "left").join(traits, "srx", "left")


def reconcile_strategy(sra: Column, author: Column, predicted: Column) -> Column:
    """A sample's strategy from the archive's, the authors' and the predicted one.

    In this order: all three alike; OTHER gives way to the authors' word if that is the predicted one
    or a single one; authors with archive and prediction apart give the list
    ``author|predicted|archive``, each name once; archive and prediction alike; EST and WGA stay where
    RNA-Seq and WGS are predicted; the rest is ``predicted|archive``. An empty or null author has said
    nothing; a missing archive or predicted value is taken from the other of the two.
    """
    sra = F.when(sra == "other", "OTHER").otherwise(sra)
    a, s, p = F.nullif(author, F.lit("")), F.coalesce(sra, predicted), F.coalesce(predicted, sra)
    listed = F.when(F.contains(a, p), a).otherwise(F.concat(a, F.lit("|"), p))
    listed = F.when(F.contains(listed, s), listed).otherwise(F.concat(listed, F.lit("|"), s))
    other = (s == "OTHER") & a.isNotNull() & ((a == p) | ~F.contains(a, F.lit("|")))
    kept = ((s == "EST") & (p == "RNA-Seq")) | ((s == "WGA") & (p == "WGS"))
    alike = F.when((s == a) & (s == p), s).when(other, a).when(a.isNotNull() & (s != p), listed).when(s == p, s)
    return F.coalesce(alike, F.when(kept, s), F.concat(p, F.lit("|"), s), a)


def reconcile_selection(sra: Column, predicted: Column) -> Column:
    """A sample's selection: the common value, or ``predicted|archive``; a missing one is taken from the other."""
    sra = F.when(sra == "other", "OTHER").otherwise(sra)
    return F.when(sra == predicted, sra).otherwise(F.nullif(F.concat_ws("|", predicted, sra), F.lit("")))


def cross_annotate(strategy: Column, selection: Column) -> tuple[Column, Column]:
    """Strategy and selection, each with the chromatin label put first that only the other has."""
    by_strategy, by_selection = F.contains(strategy, F.lit("ChIP-Seq")), F.contains(selection, F.lit("ChIP"))
    return (
        F.when(~by_strategy & by_selection, F.concat(F.lit("ChIP-Seq|"), strategy)).otherwise(strategy),
        F.when(by_strategy & ~by_selection, F.concat(F.lit("ChIP|"), selection)).otherwise(selection),
    )


def ids_with_label(df: DataFrame, key: str, col: str, label: str) -> DataFrame:
    return df.filter(F.col(col) == label).select(key).distinct()


def search_term(labels: DataFrame, catalog: DataFrame, col: str, term: str) -> DataFrame:
    """Samples whose curated column contains a term, with the number and list of their experiments."""
    hits = labels.filter(F.contains(F.lower(col), F.lit(term.lower())))
    docs = catalog.groupBy("biosample").agg(F.count("*").alias("experiments"), F.array_sort(F.collect_set("srx")).alias("srx"))
    return hits.join(docs, "biosample")


def list_projects(catalog: DataFrame, skip: int = 0, limit: int = 20) -> DataFrame:
    rows = catalog.groupBy("project").agg(F.count_distinct("biosample").alias("samples"), F.count("*").alias("experiments"))
    return rows.orderBy(F.desc("samples"), "project").offset(skip).limit(limit)


def project_detail(catalog: DataFrame, labels: DataFrame, project: str) -> DataFrame:
    return catalog.filter(F.col("project") == project).select("project", "biosample").distinct().join(labels, "biosample", "left")


def simplify_label(label: Column, keep: list[str], outlier: Column) -> Column:
    return F.when(F.coalesce(outlier, F.lit(False)), "Outlier").when(label.isin(keep), label).otherwise("Other")
