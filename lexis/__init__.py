"""lexis — Spark-native text-corpus analytics and binary text classification.

Every operator is a function from DataFrame(s) to a DataFrame (or a Column
expression), so Catalyst plans the whole job and MLlib does the fitting.
"""

__version__ = "0.1.0"
