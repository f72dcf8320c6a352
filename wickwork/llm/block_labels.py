"""Labelled text blocks, made up for training the block classifier.

Words and link shares of the block before, the block and the block after; then
whether it stands in a part named as something other than the article, in the
article element, and is a heading; then whether it is main text.
"""

FEATURES = (
    "words_before", "words", "words_after", "links_before", "links", "links_after",
    "other_part", "in_article", "heading",
)

ROWS = [
    # Menus and link lists, in a named part.
    (0, 1, 1, 0.0, 1.0, 1.0, 1, 0, 0, 0),
    (1, 1, 2, 1.0, 1.0, 1.0, 1, 0, 0, 0),
    (1, 2, 14, 1.0, 1.0, 0.0, 1, 0, 0, 0),
    (2, 3, 60, 1.0, 1.0, 0.0, 1, 0, 0, 0),
    (3, 4, 2, 1.0, 1.0, 1.0, 1, 1, 0, 0),
    # The same without a name.
    (0, 1, 1, 0.0, 1.0, 1.0, 0, 0, 0, 0),
    (1, 2, 1, 1.0, 1.0, 1.0, 0, 0, 0, 0),
    (2, 5, 3, 1.0, 1.0, 1.0, 0, 0, 0, 0),
    (40, 6, 5, 0.0, 1.0, 1.0, 0, 0, 0, 0),
    (6, 12, 9, 1.0, 0.9, 1.0, 0, 0, 0, 0),
    (4, 9, 6, 0.8, 0.8, 1.0, 0, 1, 0, 0),
    (50, 7, 6, 0.0, 1.0, 1.0, 0, 1, 0, 0),
    # Adverts, notices, forms, comments: text without links in a named part.
    (1, 8, 13, 1.0, 0.0, 0.0, 1, 0, 0, 0),
    (1, 25, 12, 1.0, 0.0, 0.0, 1, 0, 0, 0),
    (1, 70, 12, 1.0, 0.0, 0.0, 1, 0, 0, 0),
    (40, 12, 60, 0.0, 0.0, 0.0, 1, 1, 0, 0),
    (80, 30, 25, 0.0, 0.1, 0.1, 1, 0, 0, 0),
    (25, 45, 30, 0.1, 0.0, 0.0, 1, 0, 0, 0),
    (90, 55, 60, 0.0, 0.0, 0.0, 1, 1, 0, 0),
    (60, 120, 20, 0.0, 0.0, 0.0, 1, 0, 0, 0),
    (20, 3, 40, 0.0, 0.0, 0.0, 1, 0, 1, 0),
    (90, 2, 30, 0.0, 0.0, 0.0, 1, 1, 1, 0),
    # Footers.
    (60, 6, 0, 0.0, 0.0, 0.0, 1, 0, 0, 0),
    (60, 22, 0, 0.0, 0.0, 0.0, 1, 0, 0, 0),
    (7, 40, 0, 0.0, 0.2, 0.0, 1, 0, 0, 0),
    (50, 5, 0, 0.0, 0.0, 0.0, 0, 0, 0, 0),
    (4, 6, 0, 1.0, 0.2, 0.0, 0, 0, 0, 0),
    (45, 9, 3, 0.0, 0.4, 1.0, 0, 0, 0, 0),
    (3, 8, 2, 1.0, 0.0, 1.0, 0, 0, 0, 0),
    (1, 3, 1, 1.0, 0.0, 1.0, 0, 0, 0, 0),
    # Articles in their element.
    (13, 12, 70, 0.0, 0.0, 0.0, 0, 1, 1, 1),
    (25, 4, 30, 0.0, 0.0, 0.0, 0, 1, 1, 1),
    (3, 1, 5, 1.0, 0.0, 0.0, 0, 1, 1, 1),
    (12, 70, 14, 0.0, 0.0, 0.0, 0, 1, 0, 1),
    (70, 14, 5, 0.0, 0.0, 0.0, 0, 1, 0, 1),
    (14, 4, 35, 0.0, 0.0, 0.0, 0, 1, 0, 1),
    (4, 1, 22, 0.0, 0.0, 0.0, 0, 1, 0, 1),
    (35, 2, 14, 0.0, 0.0, 0.0, 0, 1, 0, 1),
    (22, 130, 40, 0.0, 0.0, 0.0, 0, 1, 0, 1),
    (10, 2, 0, 0.0, 0.0, 0.0, 0, 1, 0, 1),
    (40, 28, 60, 0.0, 0.2, 0.0, 0, 1, 0, 1),
    (28, 12, 33, 0.1, 0.4, 0.0, 0, 1, 0, 1),
    (30, 200, 20, 0.0, 0.1, 0.0, 0, 1, 0, 1),
    (12, 10, 3, 0.0, 0.1, 0.0, 0, 1, 0, 1),
    (9, 15, 4, 0.0, 0.15, 1.0, 0, 1, 0, 1),
    (3, 8, 2, 1.0, 0.25, 0.0, 0, 1, 0, 1),
    (20, 6, 25, 0.1, 0.5, 0.2, 0, 1, 0, 1),
    (5, 40, 1, 1.0, 0.05, 1.0, 0, 1, 0, 1),
    (1, 3, 1, 1.0, 0.0, 1.0, 0, 1, 0, 1),
    (0, 5, 0, 0.0, 0.0, 0.0, 0, 1, 0, 1),
    (0, 80, 0, 0.0, 0.3, 0.0, 0, 1, 0, 1),
    # Paragraphs of an article that are mostly links, between others that are not.
    (60, 8, 50, 0.0, 0.875, 0.0, 0, 1, 0, 1),
    (30, 12, 40, 0.0, 0.9, 0.1, 0, 1, 0, 1),
    (25, 6, 8, 0.0, 0.85, 0.2, 0, 1, 0, 1),
    (40, 9, 0, 0.0, 0.8, 0.0, 0, 1, 0, 1),
    (5, 14, 60, 0.0, 0.95, 0.0, 0, 1, 0, 1),
    # Articles without an element of their own.
    (0, 40, 2, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (0, 70, 5, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (2, 45, 1, 1.0, 0.0, 0.0, 0, 0, 0, 1),
    (0, 50, 0, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (40, 35, 2, 0.0, 0.0, 1.0, 0, 0, 0, 1),
    (1, 9, 60, 1.0, 0.0, 0.0, 0, 0, 1, 1),
    (9, 60, 45, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (60, 45, 80, 0.0, 0.1, 0.0, 0, 0, 0, 1),
    (45, 80, 15, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (80, 16, 40, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (16, 40, 6, 0.0, 0.0, 0.2, 0, 0, 0, 1),
    (2, 55, 30, 1.0, 0.0, 0.0, 0, 0, 0, 1),
    (55, 30, 3, 0.0, 0.15, 1.0, 0, 0, 0, 1),
    (30, 18, 50, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (50, 11, 45, 0.0, 0.0, 0.0, 0, 0, 0, 1),
]
