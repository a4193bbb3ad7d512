"""cartwheel — retail clickstream analytics on Spark.

Main entry points:

* ``cartwheel.operators.prepare.prepare_events`` / ``write_prepared`` — raw log to the
  prepared table; ``cartwheel.operators.profiling.profile_pass`` — one-scan profile.
* ``cartwheel.operators.replay`` — session sample and keyed JSON records;
  ``cartwheel.sources.log`` — Kafka or log-table source and sink.
* ``cartwheel.streaming.bronze`` / ``cartwheel.streaming.silver`` — the streams.
* ``cartwheel.operators.gold`` — Gold tables; ``inspection``, ``quality``, ``report``.
* ``cartwheel.jobs`` — command-line jobs; ``cartwheel.plans.queries`` — named queries.
"""

__version__ = "0.1.0"
