"""Named presets: the format, options, packages and settings of known systems.

A specification may give a preset's name as its format. The connector packages
are the user's to add (``--packages``); a preset only knows what to ask for.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

GRAPH_FORMAT = "graph"


class UnknownPreset(KeyError):
    """No preset has this name."""

    def __str__(self) -> str:
        return self.args[0]


@dataclass(frozen=True)
class Preset:
    """What one system needs: ``required`` options, and groups of which one is needed.

    ``upserts`` says that overwriting sets the rows with the same keys and leaves others.
    """

    name: str
    format: str
    required: tuple[str, ...] = ()
    one_of: tuple[tuple[str, ...], ...] = ()
    optional: tuple[str, ...] = ()
    packages: tuple[str, ...] = ()
    conf: Mapping[str, str] = field(default_factory=dict)
    hadoop_conf: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)
    upserts: bool = False

    @property
    def option_names(self) -> tuple[str, ...]:
        grouped = (name for group in self.one_of for name in group)
        return (*self.required, *grouped, *self.optional)

    def check(self, options: Mapping[str, str]) -> None:
        """Complain about missing options by name; values are never shown."""
        given = {name.lower() for name, value in options.items() if value.strip()}
        missing = [name for name in self.required if name.lower() not in given]
        missing += [
            " or ".join(group)
            for group in self.one_of
            if not any(name.lower() in given for name in group)
        ]
        if missing:
            raise ValueError(f"{self.name} needs the options: {', '.join(missing)}")


# Format names, option names, package coordinates and settings of
# the public connectors.
_S3_KEYS = {
    "fs.s3a.access.key": "<access key>",
    "fs.s3a.secret.key": "<secret key>",
}
_BUILT_IN = (
    Preset(
        name="Snowflake",
        format="snowflake",
        required=("sfURL",),
        one_of=(("dbtable", "query"),),
        optional=("sfUser", "sfPassword", "sfDatabase", "sfSchema", "sfWarehouse"),
        packages=(
            "net.snowflake:spark-snowflake_<scala_version>:<version>",
            "net.snowflake:snowflake-jdbc:<version>",
        ),
    ),
    Preset(
        name="Graph",
        format=GRAPH_FORMAT,
        required=("path",),
        one_of=(("labels", "relationship", "query"),),
        optional=(
            "node.keys",
            "relationship.save.strategy",
            "relationship.properties",
            "relationship.keys",
            "relationship.source.labels",
            "relationship.source.node.keys",
            "relationship.source.save.mode",
            "relationship.target.labels",
            "relationship.target.node.keys",
            "relationship.target.save.mode",
            "order.by",
            "order.late",
            "node.buckets",
            "relationship.hops",
            "delete",
            "clear",
        ),
        upserts=True,
    ),
    Preset(
        name="BigQuery",
        format="bigquery",
        one_of=(("path", "table", "query"),),
        optional=("credentials", "credentialsFile", "dataset", "parentProject"),
        packages=(
            "com.google.cloud.spark:spark-bigquery-with-dependencies_<scala_version>:<version>",
        ),
    ),
    Preset(
        name="RedShift_Community",
        format="io.github.spark_redshift_community.spark.redshift",
        required=("url", "tempdir"),
        one_of=(("dbtable", "query"),),
        optional=("tempformat", "forward_spark_s3_credentials"),
        packages=(
            "com.amazonaws:aws-java-sdk:<version>",
            "com.amazon.redshift:redshift-jdbc42:<version>",
            "org.apache.spark:spark-avro_<scala_version>:<version>",
            "io.github.spark-redshift-community:spark-redshift_<scala_version>:<version>",
        ),
        hadoop_conf=_S3_KEYS,
    ),
    Preset(
        name="RedShift_Databricks",
        format="com.databricks.spark.redshift",
        required=("url", "tempdir"),
        one_of=(("dbtable", "query"),),
        packages=(
            "com.amazonaws:aws-java-sdk:<version>",
            "com.amazon.redshift:redshift-jdbc42:<version>",
            "org.apache.spark:spark-avro_<scala_version>:<version>",
        ),
        hadoop_conf=_S3_KEYS,
    ),
    Preset(
        name="RedShift_JDBC",
        format="jdbc",
        required=("url",),
        one_of=(("dbtable", "query"),),
        optional=("partitionColumn", "lowerBound", "upperBound", "numPartitions"),
    ),
    Preset(
        name="Synapse_Databricks",
        format="com.databricks.spark.sqldw",
        required=("url", "tempDir"),
        one_of=(
            ("dbTable", "query"),
            (
                "forwardSparkAzureStorageCredentials",
                "enableServicePrincipalAuth",
                "useAzureMSI",
            ),
        ),
        packages=("com.microsoft.azure:spark-mssql-connector_<scala_version>:<version>",),
        conf={
            "fs.azure.account.key.<storage account>.dfs.core.windows.net": "<access key>",
        },
    ),
    Preset(
        name="Synapse_JDBC",
        format="jdbc",
        required=("url",),
        one_of=(("dbtable", "query"),),
        optional=("partitionColumn", "lowerBound", "upperBound", "numPartitions"),
    ),
)

_registered: dict[str, Preset] = {item.name.lower(): item for item in _BUILT_IN}


def presets() -> list[str]:
    """The names of all presets."""
    return [item.name for item in _registered.values()]


def preset(name: str) -> Preset:
    """The preset of this name, in any case."""
    try:
        return _registered[name.strip().lower()]
    except KeyError:
        raise UnknownPreset(f"no preset '{name}'; known: {', '.join(presets())}") from None


def register_preset(item: Preset) -> None:
    """Add a preset, or replace the one of that name.

    A preset named after a format class sends existing job files elsewhere: for
    example a graph connector's class name to the ``graph`` format, with the
    graph's ``path`` among the ``defaults``.
    """
    _registered[item.name.strip().lower()] = item


# Spark's own short names, which it takes in any case.
_SPARK_FORMATS = frozenset(
    {"avro", "binaryfile", "csv", "jdbc", "json", "orc", "parquet", "text", "xml"}
)


def resolve_format(format: str, options: Mapping[str, str]) -> tuple[str, dict[str, str]]:
    """The Spark format and options behind a format or preset name.

    Options are checked only where the name is a preset's, ``snowflake`` as much
    as ``Synapse_JDBC``; those of ``jdbc`` or ``parquet`` are Spark's to judge.
    """
    found = _registered.get(format.strip().lower())
    if found is None:
        short = format.strip().lower()
        return short if short in _SPARK_FORMATS or short == GRAPH_FORMAT else format, dict(options)
    merged = {**found.defaults, **options}
    found.check(merged)
    return found.format, merged


def job_stub(source: str, target: str) -> dict:
    """A job description to fill in, for two presets; plain data, ready for ``json.dump``."""
    reads, writes = preset(source), preset(target)
    packages = ", ".join(dict.fromkeys((*reads.packages, *writes.packages)))
    return {
        "name": f"{reads.name} to {writes.name}" + (f" (needs {packages})" if packages else ""),
        "master": "",
        "conf": {**reads.conf, **writes.conf},
        "hadoopConfiguration": {**reads.hadoop_conf, **writes.hadoop_conf},
        "source": {
            "format": reads.format,
            "options": {name: f"<{name}>" for name in reads.option_names},
            "columns": [{"name": "<column or SQL expression>", "alias": "<new name>"}],
            "where": "<SQL condition>",
            "printSchema": False,
            "limit": -1,
            "show": -1,
            "partition": {"number": -1, "by": ""},
        },
        "target": {
            "format": writes.format,
            "options": {name: f"<{name}>" for name in writes.option_names},
            "mode": "<append, overwrite, ignore or error>",
        },
    }
