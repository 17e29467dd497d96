"""DataFrame -> DataFrame operators.

readings     clean (exact copies, pair rules), index, deletes, duplicate checks
quality      gates that abort a job, observed row counts
submeters    submeter -> main-meter map, exclusion
hourly       hourly usage per meter, first-generation aggregates
usage        system totals, month-hour profile and ranks, top hours, AMI vs VEE
diagnostics  readings per meter-day, volume and duplicate checks
loadcontrol  event periods, points, fulfilment, controlled-hours analysis
peaks        workbook slicing, coincident peaks, peak-hour usage
calendar     5-minute calendar with weekend and holiday flags
changes      upsert, change rows, high water, re-aggregation scope
"""
