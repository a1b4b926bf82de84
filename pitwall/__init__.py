"""pitwall: motor-racing timing data on Spark, from landed records to reports.

Layers: landed JSON -> raw tables -> staging -> marts -> reports, with data
checks and promotion beside them. Everything takes and returns DataFrames;
writers live in ``sinks`` and ``streaming`` only.
"""
