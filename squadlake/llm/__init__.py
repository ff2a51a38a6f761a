"""Operators for training-data pipelines, each by one named method.

``simhash``          near-duplicate documents by fingerprints and trees over bit distance
``suffixes``         repeated passages by sparse suffix arrays
``chat``             conversations as token sequences with loss masks
``toxicity``         subsequence string kernel with landmarks, linear support vector machine
``quality``          character n-gram language model, thresholds by language
``leaks``            secrets by trigram postings and regular expressions
``packing``          documents into token windows by dynamic programming
``sharding``         contiguous shards of equal size over groups of equal texts
``search``           exact inner-product search by bit-sliced indexes
``decontamination``  benchmark passages in documents
``fill_in_middle``   texts rearranged around marks in columnar batches
``token_files``      token ids as flat files with 64-bit offsets
``centroids``        vectors clustered by exact nearest centroids

Nothing outside this package imports it.
"""
