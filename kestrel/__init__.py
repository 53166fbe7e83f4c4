"""kestrel — binary classification on tables, expressed as Spark DataFrame jobs and pyspark.ml stages.

Layout:
  sources/    scans, fixtures, sinks, model persistence
  functions/  column expressions (derived features, row statistics, md5 draws)
  operators/  splits, prefix sums, exact quantiles, preprocessing, metrics, learners, ensembles
  plans/      end-to-end jobs: experiment, randomized search, tuned training, batch scoring
  streaming/  the fitted (stateless) scoring pipeline over a file stream
"""

__version__ = "0.1.0"
