"""Word lists used by the stopword cleaning variants.

Fixed values (they must equal the reference's lists for equal results):

* ``NEGATION_WHITELIST`` — ten negation words that are never removed.
* ``CURATED_STOPWORDS`` — the curated pure-grammar list of the "curated" variant.
* ``GENERAL_STOPWORDS`` — the widely published 179-word English stopword list
  (the classic NLTK ``english`` corpus); the "general" variant removes these
  minus the negation whitelist.  The reference downloads that list unpinned at
  run time; this module pins version ``english-179``.
"""

from __future__ import annotations

GENERAL_LIST_VERSION = "english-179"

NEGATION_WHITELIST = (
    "no", "not", "never", "nor", "neither",
    "without", "nothing", "nobody", "nowhere", "none",
)

CURATED_STOPWORDS = (
    # articles
    "a", "an", "the",
    # prepositions
    "of", "in", "on", "at", "to", "for", "with", "by", "from",
    "into", "onto", "upon", "over", "under", "about", "above",
    "below", "between", "through", "during", "before", "after",
    # conjunctions
    "and", "or", "but", "so", "if", "because", "although", "though",
    "while", "since", "unless", "until", "whereas",
    # auxiliaries
    "is", "am", "are", "was", "were", "be", "been", "being",
    "has", "have", "had", "do", "does", "did",
    "will", "would", "shall", "should", "can", "could", "may",
    "might", "must",
    # grammatical pronouns / determiners
    "this", "that", "these", "those", "it", "its",
)

GENERAL_STOPWORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between",
    "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "don't", "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain",
    "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't",
    "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma",
    "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't",
    "wouldn", "wouldn't",
)


def general_without_negations() -> list[str]:
    """Set difference general list − negation whitelist, sorted."""
    keep = set(NEGATION_WHITELIST)
    return sorted(set(GENERAL_STOPWORDS) - keep)


def curated() -> list[str]:
    return sorted(set(CURATED_STOPWORDS))
