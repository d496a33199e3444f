"""Scans (2.A). Every reader takes an explicit schema (no inference pass
over 100 TB), keeps files splittable, and leaves column pruning and
predicate pushdown to the optimizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicarium import schema as S
from indicarium.functions.text import printable_clean

LATIN1 = "ISO-8859-1"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def delimited_scan(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";",
                   encoding: str = LATIN1, header: bool = True, columns: list[str] | None = None,
                   **options) -> DataFrame:
    """A1: delimited text with an explicit schema; ``columns`` prunes. A file
    whose header does not name the schema's columns in their order is an error."""
    df = (spark.read.schema(schema).option("sep", sep).option("encoding", encoding)
          .option("header", str(header).lower()).option("enforceSchema", str(not header).lower()).options(**options).csv(path))
    return df.select(*columns) if columns else df


def preamble_tolerant_scan(spark: SparkSession, path: str, schema: T.StructType, header_value: str,
                           value_index: int = 1, sep: str = ";", encoding: str = LATIN1, body: str = ".*") -> DataFrame:
    """A2: title lines before the header and notes after the table.

    Read without a header (every split stays independent): title and
    footer lines have no second field, so they come back with a null
    value and are dropped; the header line is removed by its first cell.
    ``body`` is a pattern of the first cells of table lines, for files whose
    title or notes hold the separator.
    """
    df = delimited_scan(spark, path, schema, sep=sep, encoding=encoding, header=False)
    first, value = schema.fieldNames()[0], schema.fieldNames()[value_index]
    return df.filter(F.col(value).isNotNull() & (F.col(first) != header_value) & F.col(first).rlike(body))


def malformed_skipping_scan(spark: SparkSession, path: str, schema: T.StructType | str,
                            sep: str = ";", encoding: str = LATIN1, header: bool = True) -> DataFrame:
    """A3: rows that do not fit the schema are skipped. Every column takes part
    in the filter, so whole lines are parsed and the columns read later
    don't change which rows fit."""
    fields = spark.createDataFrame([], schema).schema.fields
    kept = T.StructType([*fields, T.StructField("__corrupt", T.StringType())])
    df = (spark.read.schema(kept).option("sep", sep).option("encoding", encoding).option("header", str(header).lower())
          .option("columnNameOfCorruptRecord", "__corrupt").csv(path))
    whole = F.length(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in fields])) >= 0
    return df.where(F.col("__corrupt").isNull() & whole).drop("__corrupt")


def quoted_clean_scan(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                      encoding: str = LATIN1) -> DataFrame:
    """A4: quoted CSV; every string cell cleaned to printable text."""
    df = delimited_scan(spark, path, schema, sep=sep, encoding=encoding, quote='"', escape='"')
    return df.select(*[printable_clean(c).alias(c) if t == "string" else F.col(c)
                       for c, t in df.dtypes])


API_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("variavel", T.StringType()),
    T.StructField("unidade", T.StringType()),
    T.StructField("resultados", T.ArrayType(T.StructType([
        T.StructField("classificacoes", T.ArrayType(T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("nome", T.StringType()),
            T.StructField("categoria", T.MapType(T.StringType(), T.StringType())),
        ]))),
        T.StructField("series", T.ArrayType(T.StructType([
            T.StructField("localidade", T.StructType([
                T.StructField("id", T.StringType()),
                T.StructField("nome", T.StringType()),
            ])),
            T.StructField("serie", T.MapType(T.StringType(), T.StringType())),
        ]))),
    ]))),
])


def flatten_api(df: DataFrame, doc: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """A5: variable -> results -> localities -> year map, one row per
    (variable, result, locality, year). ``doc`` names a struct column
    holding the document; by default the document fields are top level.

    Output: variavel_id, variavel, unidade, resultado (position),
    classificacao, codigo_municipio, nome_municipio, ano, raw.
    """
    keep = keep or []
    base = df.select(*keep, F.col(f"{doc}.*")) if doc else df
    # outer: for a plain explode Spark infers filters on the list and pushes them below what made it, so that each document is parsed again for each
    r = base.select(*keep, F.col("id").alias("variavel_id"), "variavel", "unidade",
                    F.posexplode_outer("resultados").alias("resultado", "__r")).where(F.col("resultado").isNotNull())
    s = r.select(*keep, "variavel_id", "variavel", "unidade", "resultado",
                 F.array_join(F.transform("__r.classificacoes", lambda c: c["id"]), ",").alias("classificacao"),
                 F.explode("__r.series").alias("__s"))
    return s.select(*keep, "variavel_id", "variavel", "unidade", "resultado", "classificacao",
                    F.col("__s.localidade.id").try_cast("bigint").alias(S.CITY_CODE_COL),
                    F.col("__s.localidade.nome").alias("nome_municipio"),
                    F.explode("__s.serie").alias("__ano", "raw")) \
            .withColumn(S.YEAR_COL, F.col("__ano").try_cast("int")).drop("__ano")


def read_api_json(spark: SparkSession, path: str) -> DataFrame:
    """A5: landed API answers (a JSON array of variables per file)."""
    return flatten_api(spark.read.schema(API_SCHEMA).option("multiLine", "true").json(path))


def frame_answers(spark: SparkSession, path: str, out: str) -> None:
    """Land API answers (JSON arrays, a file each) as a document per line. An
    array can't be split, so this reads each file in one task, once; what
    reads the lines is as parallel as their bytes allow. Documents keep whatever shape they have."""
    docs = spark.read.option("singleVariantColumn", "doc").option("multiLine", "true").json(path)
    each = docs.select(F.posexplode_outer(F.col("doc").cast("array<variant>")).alias("pos", "value")).where(F.col("pos").isNotNull())  # outer: as in flatten_api
    each.select(F.to_json("value").alias("value")).write.text(out)


def read_api_lines(spark: SparkSession, path: str, keep: dict[str, str] | None = None) -> DataFrame:
    """A5 over lines of ``frame_answers``: the documents are VARIANTs, so that
    those of another shape don't become nulls unseen. ``resultados`` may be a list or a
    single result; any other shape, or a line that is no JSON, is an
    error. ``keep``: further fields of a document, name -> type."""
    doc = spark.read.text(path).select(F.parse_json("value").alias("doc"))
    several = API_SCHEMA["resultados"].dataType
    got = F.coalesce(
        F.try_variant_get("doc", "$.resultados", several.simpleString()),
        F.array(F.try_variant_get("doc", "$.resultados", several.elementType.simpleString())))
    fields = {"id": "string", "variavel": "string", "unidade": "string"} | (keep or {})
    read = doc.select("doc", *[F.variant_get("doc", f"$.{n}", t).alias(n) for n, t in fields.items()], got.alias("__got"))  # a column, so that it is made once
    odd = F.col("__got")[0].isNull() & (F.size("__got") > 0) & F.try_variant_get("doc", "$.resultados", "variant").isNotNull()
    results = F.when(odd, F.raise_error(F.concat(F.lit("an answer of another shape: "), F.to_json("doc"))).cast(several)).otherwise(F.col("__got"))
    return flatten_api(read.select(*fields, results.alias("resultados")), keep=list(keep or {}))


FLAT_SERIES_SCHEMA = "id string, periodo string, valor string, cod string"


def read_flat_json(spark: SparkSession, path: str, schema: str = FLAT_SERIES_SCHEMA) -> DataFrame:
    """A JSON array of flat records."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


CATALOGUE_TYPE = T.MapType(T.StringType(), T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))


def catalogue_rows(doc: DataFrame, col: str = "catalogo") -> DataFrame:
    """A catalogue document topic -> indicator -> params as rows
    (topico, nome_dado, params)."""
    t = doc.select(F.explode(F.col(col)).alias("topico", "__inds"))
    return t.select("topico", F.explode("__inds").alias("nome_dado", "params"))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """JSON catalogue files (one object per file)."""
    text = spark.read.option("wholetext", "true").text(path)
    doc = F.coalesce(F.from_json("value", CATALOGUE_TYPE), F.raise_error(F.lit("a catalogue must be a JSON object")))
    return catalogue_rows(text.select(doc.alias("catalogo")))


def read_survey_catalogue(spark: SparkSession, information: str, codes: str) -> DataFrame:
    """A7 in the survey's two files: question -> {categoria, tipo}, and year ->
    question -> code. One row for each question of a year: ano, codigo, nome,
    topico, tipo. A question without information is an error."""
    def document(path: str, kind: str) -> DataFrame:
        text = spark.read.option("wholetext", "true").text(path)
        doc = F.coalesce(F.from_json("value", kind), F.raise_error(F.lit(f"no survey catalogue: {path}")))
        return text.select(F.explode(doc).alias("k", "v"))

    known = document(information, "map<string,map<string,string>>").select(F.col("k").alias("nome"), F.col("v.categoria").alias("topico"), F.col("v.tipo").alias("tipo"))
    coded = document(codes, "map<string,map<string,string>>").select(F.col("k").cast("int").alias(S.YEAR_COL), F.explode("v").alias("nome", "codigo"))
    told = F.coalesce("tipo", F.raise_error(F.concat(F.lit("no information on the question "), "nome")))
    return coded.join(known, "nome", "left").select(S.YEAR_COL, "codigo", "nome", "topico", told.alias("tipo"))


def yearly_files_scan(spark: SparkSession, root: str, schema: T.StructType | str, glob: str,
                      sep: str = ";", encoding: str = LATIN1, year_regex: str = r"(\d{4})",
                      header: bool = True) -> DataFrame:
    """Recurse a folder, keep files by name glob, year from the path.

    The year is an expression of the file's path alone, so a filter on it
    chooses files: those of other years are listed and never opened."""
    df = (spark.read.schema(schema).option("sep", sep).option("encoding", encoding)
          .option("header", str(header).lower()).option("enforceSchema", str(not header).lower())
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).csv(root))
    return df.withColumn(S.YEAR_COL, F.regexp_extract(F.col("_metadata.file_path"), year_regex, 1).try_cast("int"))


def side_file_split(spark: SparkSession, root: str, fact_schema, fact_glob: str, lookup_schema,
                    lookup_glob: str, lookup_header: bool | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """One folder, two kinds of files: facts and a lookup (told apart
    by file-name pattern; the lookup may differ in header)."""
    lk = dict(kw)
    if lookup_header is not None:
        lk["header"] = lookup_header
    return (yearly_files_scan(spark, root, fact_schema, fact_glob, **kw),
            yearly_files_scan(spark, root, lookup_schema, lookup_glob, **lk).drop(S.YEAR_COL))


def write_dimension(df: DataFrame, table: str, key: str, path: str, buckets: int = 64) -> None:
    """A10: a dimension as a catalog table, bucketed and sorted by its key (natural
    key of F1/F6, name key of F7): joins on that key don't shuffle it."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def read_dimension(spark: SparkSession, table: str | None = None, path: str | None = None,
                   jdbc_url: str | None = None, properties: dict | None = None) -> DataFrame:
    """A10: a dimension from a catalog table, a parquet path or JDBC."""
    if jdbc_url:
        return spark.read.jdbc(jdbc_url, table, properties=properties or {})
    if table:
        return spark.table(table)
    return spark.read.parquet(path)


def read_municipalities(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The municipality reference list (code, name, state)."""
    return delimited_scan(spark, path, S.MUNICIPALITY_SCHEMA, sep=sep, encoding="UTF-8")


def city_codes(municipalities: DataFrame) -> DataFrame:
    """A11 accessor: the codes."""
    return municipalities.select(S.CITY_CODE_COL)


def name_code_map(municipalities: DataFrame, inverse: bool = False) -> DataFrame:
    """A11 accessor: name -> code rows (or code -> name)."""
    if inverse:
        return municipalities.select(F.col(S.CITY_CODE_COL).alias("chave"), F.col("nome_municipio").alias("valor"))
    return municipalities.select(F.col("nome_municipio").alias("chave"), F.col(S.CITY_CODE_COL).alias("valor"))
