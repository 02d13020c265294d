"""Operators of a training-data pipeline.

Each module is one operator with its own interface (DataFrame in, DataFrame out);
``queries`` binds them to the given tables. Nothing else in the library imports this
package.
"""
