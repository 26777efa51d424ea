"""plyspark: a Spark DataFrame pipeline for analysed two-player match data.

feed (NDJSON) -> games / moves / move_evals -> staging -> per-ply features,
opening sequences, rating trajectories -> match fact, player and opening
dimensions -> data checks.
"""

__version__ = "0.1.0"
