"""Training-data operators: ten corpus operators and their registered queries.

Nothing outside this subpackage imports it.  ``quire.llm.queries`` holds the
``opN_<name>`` queries; ``__spark_entry__`` adds them when the subpackage is
present.  Each operator lives in a module of its own and takes any DataFrame
with an id and a text (or URL, or vector) column; extra columns, whatever
their names, are ignored, because operators project their own columns first.
"""
