"""vigiframe: reference-data publishing and query engine on Spark.

Every operator is a function ``DataFrame -> DataFrame`` or ``Column -> Column``
built from Spark SQL expressions, so Catalyst plans it and whole-stage codegen
runs it; nothing iterates rows in Python.

Entry points:
    vigiframe.session.build_session / scale_conf   session and partition sizing
    vigiframe.plans.jobs                            publication jobs (also a CLI)
    vigiframe.plans.pipelines                       the reference pipelines as lazy plans
    vigiframe.sinks.reference.read_reference        consumer lookup of a published reference
    vigiframe.plans.catalog.QUERIES / ORACLE        registered queries and their DuckDB SQL
"""

__version__ = "0.1.0"
