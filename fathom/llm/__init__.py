"""Operators of a training-data pipeline. Nothing else in the library imports this package.

| module          | operator                                                             |
|-----------------|----------------------------------------------------------------------|
| token_index     | 1 token-id payload files with a minimal perfect hash index           |
| crf             | 2 quality: linear-chain conditional random field over lines          |
| packing         | 3 best-fit-decreasing packing with a capacity segment tree           |
| substring       | 4 repeated token windows by Rabin-Karp hashes                        |
| toxicity        | 5 FTRL-proximal logistic regression over hashed n- and skip-grams     |
| iblt            | 6 invertible Bloom lookup sketches of paragraphs (native)            |
| decontam        | 7 benchmark windows by SimHash and Hamming blocks (native)           |
| licenses        | 8 licence rules over recognised sentences (native)                   |
| neardup         | 9 SimHash near-duplicates with sharded BK-trees                      |
| chat            | 10 chat formatting in budgeted windows (native)                      |
| structure       | 11 cheapest repair of conversations by a suffix-shared automaton     |
| mixing          | 12 sources mixed to target weights by van der Corput slots           |
| lexical         | 13 exact ranked search with sparse ball trees                        |

``queries`` registers one query per operator and the pipeline.
"""
