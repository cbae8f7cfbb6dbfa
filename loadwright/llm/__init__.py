"""Operators for preparing training data at corpus scale.

One module per operator; ``queries`` registers them.  Nothing outside this
package imports it.  Every operator takes DataFrames, returns DataFrames and
keeps intermediate tables below the shared folder of ``spark.checkpoint.dir``.
"""
