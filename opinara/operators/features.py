"""Count and TF-IDF features.

A fitted ``TermModel`` holds a vocabulary of at most ``max_features`` terms. It turns texts into
sparse vectors row by row inside the JVM, without a shuffle; documents without known terms get an
empty vector.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import lru_cache

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from opinara.config import FeatureConfig
from opinara.functions.rows import element_rows, struct_rows
from opinara.functions.tokens import terms_of_tokens, with_terms, with_tokens
from opinara.operators.recurrence import without_single_terms
from opinara.operators.term_batches import counted_terms, vectors


def term_counts(docs: DataFrame, terms: str = "terms", id_col: str = "id") -> DataFrame:
    """``(id, term, n)``."""
    exploded = element_rows(docs, F.col(terms), "term", id_col)
    return exploded.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("n"))


def term_statistics(docs: DataFrame, terms: str = "terms", of_tokens: FeatureConfig | None = None) -> DataFrame:
    """``(term, df, cf)``: documents with the term, and occurrences.

    With ``of_tokens`` the column holds tokens (``with_tokens``), of which tasks make the terms: n-grams
    then cross to no other process or task but as counts.

    Tasks count both over slices of their rows, and the slices' counts are added up by term.
    Counting per document first would shuffle the whole corpus.
    """
    counted = docs.select(terms).mapInArrow(counted_terms(of_tokens), "term string, df bigint, cf bigint")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _df_bound(limit: int | float, n_docs: Column) -> Column:
    """A whole number is a row count; a fraction is a share of the rows."""
    return F.lit(limit) if isinstance(limit, int) else F.lit(float(limit)) * n_docs


#: From so many bytes of input on, a pass that spares terms of one document the shuffle is made. It reads
#: and cuts every text once more, which costs more than it spares until shuffles fill the disks.
SPARED_BYTES = 64 << 30


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a plan's size."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fit_vocabulary(
    docs: DataFrame, config: FeatureConfig, terms: str = "terms", spare_singles: bool | None = None,
    of_tokens: bool = False,
) -> DataFrame:
    """``(term, idx, df, cf, idf)``: the ``max_features`` most frequent terms within the document
    frequency bounds, indexed alphabetically. Equal frequencies go by term.

    Where a term needs two documents, ``spare_singles`` keeps terms of one out of the shuffle (see
    ``recurrence``); it changes no row. Unless told, large inputs do so: the pass pays where rows
    cross a network. With ``of_tokens`` the column holds the tokens of ``config`` (``with_tokens``).
    """
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    if spare_singles is None:
        spare_singles = input_bytes(docs) >= SPARED_BYTES
    if spare_singles and isinstance(config.min_df, int) and config.min_df >= 2:
        docs, of_tokens = without_single_terms(terms_of_tokens(docs, terms, config) if of_tokens else docs, terms), False
    kept = (
        term_statistics(docs, terms, config if of_tokens else None)
        .crossJoin(F.broadcast(n_docs))
        .where(
            (F.col("df") >= _df_bound(config.min_df, F.col("n_docs")))
            & (F.col("df") <= _df_bound(config.max_df, F.col("n_docs")))
        )
        .orderBy(F.desc("cf"), "term")
        .limit(config.max_features)
    )
    # At most max_features rows reach this window.
    place = F.row_number().over(W.partitionBy(F.lit(1)).orderBy("term"))
    idf = F.log((1.0 + F.col("n_docs")) / (1.0 + F.col("df"))) + 1.0
    return kept.select("term", (place - 1).cast("int").alias("idx"), "df", "cf", idf.alias("idf"))


def vocab_join(counts: DataFrame, vocabulary: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, term, idx, n)`` of the known terms. The vocabulary has at most ``max_features`` rows."""
    return counts.join(F.broadcast(vocabulary.select("term", "idx")), "term").select(id_col, "term", "idx", "n")


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A vector from index and value arrays, built by the JVM."""
    body = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        indices.alias("indices"),
        values.alias("values"),
    )
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(body.alias("v"))), schema)["v"]


def scaled(df: DataFrame, factors: list[float] | tuple[float, ...], vector: str, out: str) -> DataFrame:
    """Multiply a vector elementwise by fixed factors."""
    return ElementwiseProduct(scalingVec=DenseVector(factors), inputCol=vector, outputCol=out).transform(df)


def dot(df: DataFrame, weights: list[float] | tuple[float, ...], vector: str, out: str) -> DataFrame:
    """Inner product of a sparse vector column with fixed weights."""
    names = df.columns
    products = F.unwrap_udt("__product")["values"]
    total = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    return scaled(df, weights, vector, "__product").select(*names, total.alias(out))


@lru_cache(maxsize=8)
def _counter(vocabulary: tuple[str, ...], application: str) -> CountVectorizerModel:
    """Terms to counts. Handing a vocabulary to the JVM takes seconds, so recent ones are kept."""
    return CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol="__terms", outputCol="__counts")


@dataclass(frozen=True)
class TermModel:
    config: FeatureConfig
    vocabulary: tuple[str, ...]
    idf: tuple[float, ...]

    @classmethod
    def fit(cls, docs: DataFrame, config: FeatureConfig, text: str = "clean_review") -> TermModel:
        found = fit_vocabulary(with_tokens(docs.select(text), text, config), config, "tokens", of_tokens=True)
        rows = sorted(found.select("idx", "term", "idf").collect())
        if not rows:
            raise ValueError("no term passes the document frequency bounds")
        return cls(config, tuple(r.term for r in rows), tuple(r.idf for r in rows))

    def transform(self, df: DataFrame, text: str = "clean_review", out: str = "features") -> DataFrame:
        """Add the feature vector; a row-by-row step."""
        if df.isStreaming:
            return self._projected(df, text, out)
        names = df.columns
        vector = vectors(self.config, self.vocabulary, self.idf)
        return with_tokens(df, text, self.config, "__tokens").select(*names, vector(F.col("__tokens")).alias(out))

    def _projected(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """``transform`` by the JVM's own steps alone, as a stream's projections need them."""
        names = df.columns
        size = len(self.vocabulary)
        df = with_terms(df, text, self.config, "__terms")
        counter = _counter(self.vocabulary, df.sparkSession.sparkContext.applicationId)
        df = counter.transform(df).drop("__terms")
        if self.config.strategy == "count":
            return df.select(*names, F.col("__counts").alias(out))
        df = scaled(df, self.idf, "__counts", "__weighted")
        if self.config.sublinear_tf:
            counts, weighted = F.unwrap_udt("__counts"), F.unwrap_udt("__weighted")
            damped = F.zip_with(counts["values"], weighted["values"], lambda n, w: w * (1.0 + F.log(n)) / n)
            df = df.select(*names, sparse_vector(size, counts["indices"], damped).alias("__weighted"))
        unit = Normalizer(p=2.0, inputCol="__weighted", outputCol="__unit").transform(df)
        return unit.select(*names, F.col("__unit").alias(out))

    def weights(self, df: DataFrame, text: str = "clean_review", id_col: str = "id") -> DataFrame:
        """Long form ``(id, term, weight)``."""
        vectors = self.transform(df.select(id_col, text), text)
        entries = vector_entries(vectors, id_col)
        return entries.join(F.broadcast(self.terms(df.sparkSession)), "idx").select(id_col, "term", "weight")

    def terms(self, spark: SparkSession) -> DataFrame:
        """``(idx, term, idf)``."""
        rows = [(i, t, v) for i, (t, v) in enumerate(zip(self.vocabulary, self.idf))]
        return spark.createDataFrame(rows, "idx int, term string, idf double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.terms(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/terms")
        settings = {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(self.config).items()}
        write_settings(spark, settings, f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TermModel:
        settings = read_settings(spark, f"{path}/settings")
        settings["ngram_range"] = tuple(settings["ngram_range"])
        rows = sorted(spark.read.parquet(f"{path}/terms").collect())
        return cls(FeatureConfig(**settings), tuple(r.term for r in rows), tuple(r.idf for r in rows))


def vector_entries(df: DataFrame, *keep: str, vector: str = "features") -> DataFrame:
    """One row per non-zero entry: ``(*keep, idx, weight)``."""
    parts = F.unwrap_udt(vector)
    pairs = F.arrays_zip(parts["indices"].alias("idx"), parts["values"].alias("weight"))
    return struct_rows(df, pairs, *keep, required="idx")


def write_settings(spark: SparkSession, settings: dict, path: str) -> None:
    """A one-row JSON table; plain values keep their types."""
    spark.createDataFrame([(json.dumps(settings, sort_keys=True),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_settings(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
