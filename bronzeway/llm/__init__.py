"""Operations of training-data pipelines: ten operators and their queries.

Nothing else in the library imports this subpackage.
"""
