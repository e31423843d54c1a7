"""Expressions as SQL text.

Every function takes SQL expressions (a column name is one) and returns one, for ``F.expr``,
``selectExpr`` or ``spark.sql``. One text is one call to the JVM however many operators it holds, and all
of it is built-in functions, so it stays inside whole-stage codegen.
"""
