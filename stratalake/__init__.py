"""Medallion analytics as parameterised DataFrame operators.

``functions`` holds column expressions, ``operators`` DataFrame-to-DataFrame
building blocks, ``plans`` the composed layer tables and marts, ``sources``
readers, sinks and run metrics, and ``streaming`` the Structured Streaming twins.
"""
