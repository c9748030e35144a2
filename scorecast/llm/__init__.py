"""Training-data operators: each module is one operator of the text pipeline.

Nothing outside this subpackage imports it; ``queries`` registers the
``opN_*`` queries and ``/corpus_pipeline.py`` chains five of the operators.
"""
