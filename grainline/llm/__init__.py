"""Operators for building training corpora at scale. Nothing else in the library imports this package.

Modules: ``quality`` (isolation forest on rule statistics), ``bpe`` (byte-level BPE), ``ngram_lm``
(Elias-Fano n-gram trie), ``sanitise`` (personal data and disclosing terms), ``mixing`` (target weights),
``mtree`` (exact top-k), ``bagminhash`` (weighted near-duplicates), ``licences``, ``langid``, ``toxicity``;
``queries`` registers one thin query per operator.
"""
