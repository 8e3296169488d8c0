"""Spark-native viewer-behaviour analytics: search intent and watch behaviour
joined into one wide row per user, plus the business questions asked of it."""

__version__ = "0.1.0"
