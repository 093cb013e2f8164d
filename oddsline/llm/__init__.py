"""Operators of a training-data pipeline (see README, "Training-data operators").

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries only while the package can be imported.
"""
