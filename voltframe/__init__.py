"""voltframe: interval-meter analytics as Spark DataFrame operators.

Layers:
  functions/  column expressions (time index, local time, text keys, holidays)
  sources/    readers for landing files, dimension CSVs, sheet cells, driver fixtures
  operators/  DataFrame -> DataFrame operators (cleaning, hourly, load control, peaks, ...)
  plans/      composite jobs and the query catalogue used by the driver
  streaming/  file-stream ingest and the incremental micro-batch chain
"""

__version__ = "0.1.0"
