"""paylake: card-payment lakehouse jobs expressed as Spark DataFrame plans.

Layers: raw CSV -> bronze (all strings) -> silver (typed, audited) -> gold
(trailing-window customer and terminal features), plus fraud labelling,
radius joins between customers and terminals, daily statistics and
chronological ids.  Every operator is a function DataFrame -> DataFrame.
"""

__version__ = "0.1.0"
