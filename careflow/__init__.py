"""careflow: care-pathway analytics as Spark DataFrame jobs.

Entry points
* ``careflow.session.get_session``           session with the settings the jobs rely on
* ``careflow.sources``                        CSV scan, table store and sinks, generator
* ``careflow.operators.validate``             rule validation and quarantine split
* ``careflow.operators.warehouse``            dimensions, facts, journeys, therapy switches
* ``careflow.operators.incremental``          high-water mark, upsert, SCD-2 merge
* ``careflow.operators.quality``              data-quality checks, report, gate, trend
* ``careflow.operators.kpis``                 KPI / API / dashboard queries
* ``careflow.operators.anomaly`` / ``forest`` physician features, isolation forest, z-score
* ``careflow.plans.full_run.run``             the batch job (any subset of its steps)
* ``careflow.streaming.incremental_stream``   incremental ingest as a file stream
"""

__version__ = "0.1.0"
