"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.session import new_folder

#: ASCII white space as a regular-expression class, and words between it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a few numbers that are broadcast at most (about 10 MB).
BROADCAST_ROWS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    The files outlive executors, so a lost one costs only its running tasks.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name as Spark reads it, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def every_column(docs: DataFrame) -> list[Column]:
    return [docs[quoted(c)] for c in docs.columns]


def fresh_name(docs: DataFrame, stem: str) -> str:
    """A column name that ``docs`` does not have, in any case."""
    taken, name = {c.lower() for c in docs.columns}, f"_{stem}"
    while name in taken:
        name = f"_{name}"
    return name


def sliced(batches, rows: int):
    """Arrow batches cut to at most ``rows`` rows, so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_rows(docs: DataFrame, function, *added: T.StructField) -> DataFrame:
    """``docs.mapInArrow(function)`` with all its columns, and ``added`` ones, whatever their names are."""
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    plain = docs.toDF(*[f.name for f in fields])
    return plain.mapInArrow(function, T.StructType(fields + list(added))).toDF(*docs.columns, *[f.name for f in added])


def built_side(ids: DataFrame) -> DataFrame:
    """``ids`` as the built side of a hash join: broadcast if counted to be few, else shuffled.

    The count is taken on the rows as they are, so pass rows that are cheap to read twice.
    """
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(ids) if few else ids.hint("shuffle_hash")


def without_ids(docs: DataFrame, removed: DataFrame, key: str = "doc_id", nulls: bool = False) -> DataFrame:
    """The rows of ``docs`` whose key is not in ``removed`` (one column of that name).

    The ids are the built side of a hash join, so texts are at most shuffled, never
    sorted. Rows with a null key stay, unless ``nulls`` lets a null be removed too.
    """
    name = fresh_name(docs, "removed")
    ids = built_side(written(removed.select(F.col(quoted(key)).alias(name)).distinct(), "removed"))
    own = docs[quoted(key)]
    same = own.eqNullSafe(ids[name]) if nulls else own == ids[name]
    return docs.join(ids, same, "left_anti").select(*every_column(docs))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """The path of a public tokenizer's vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
