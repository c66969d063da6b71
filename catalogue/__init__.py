"""The registered queries and the SQL they are checked against."""

from . import judging, parity, profiling, trends

QUERIES = profiling.QUERIES | judging.QUERIES | parity.QUERIES | trends.QUERIES
ORACLES = profiling.ORACLES | judging.ORACLES | parity.ORACLES | trends.ORACLES
