"""strata: a Spark-native retail medallion warehouse.

Layers: CSV landing -> bronze (raw tables) -> silver (cleansed) -> gold
(star schema), plus analytics queries and data-quality checks over every
layer.  Everything is DataFrame work; see README.md for the layout.
"""

from strata.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
