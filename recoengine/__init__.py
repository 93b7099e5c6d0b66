"""recoengine: a PySpark-native recommendation analytics engine.

Batch statistics, explicit-feedback ALS, blocked factor products and a
Structured Streaming recommender, all expressed as DataFrame / SQL /
MLlib plans so Catalyst and AQE choose the physical strategy.
"""

__all__ = ["session", "schemas", "fixtures"]
