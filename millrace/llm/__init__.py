"""Operations of a training-data pipeline over large text collections.

Each module holds one operator.  Operators take DataFrames and return DataFrames; the
columns they read are parameters, and they carry none but those they name, so extra
columns of the input, whatever they are called, never clash.  ``registry`` applies them
to the tables ``documents``, ``pages`` and ``embeddings``.
"""
