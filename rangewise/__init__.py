"""rangewise: a species-observation warehouse built as Spark DataFrame jobs.

Layers: ``sources`` (raw inputs: TSV files, polygon layers, fixture
derivations), ``functions`` (column expressions: geometry, text),
``operators`` (the transforms and checks), ``plans`` (the star schema, the
refresh job and the analyst reports), ``llm`` (training-text operators).
"""
