"""contractgate: a Spark-native data-contract ingestion gate.

Main entry points:

* ``operators.contract.load_contract`` / ``lint_contract`` / ``contracts_table``
* ``operators.validate.validate(df, contract, batch=[...])`` -> violations,
  verdicts and ``manifest()`` (lazy DataFrames, one aggregate pass)
* ``operators.route.route`` and ``plans.batches.gate_by_day`` for batches that
  come from a column
* ``operators.project.apply_contract_types`` (typed projection)
* ``plans.ingest.ingest`` / ``stage`` / ``run_load`` / ``watermark_report``
  (the jobs; ``python -m contractgate`` runs them from the command line)
* ``operators.state.WatermarkStore`` / ``LoadLog`` (append-only state tables)
* ``streaming.landing.stream_ingest`` (new files gated as they arrive)
"""
