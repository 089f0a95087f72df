"""Small inputs of a lending library: members, loans, branches and terms."""

import datetime as dt

MEMBER_SCHEMA = "member_no int, full_name string, contact string, branch string, tier string"
MEMBERS = [
    (11, "Ada Quill", "ada@books.test", "North", "basic"),
    (12, "Ben Marrow", "ben@books.test", "South", "basic"),
    (13, "Cleo Finch", "cleo@books.test", "East", "paused"),
]
#: one member corrected, one new
MEMBER_FIXES = [
    (11, "Ada Quill-Roe", "ada.roe@books.test", "North", "basic"),
    (14, "Dov Larch", "dov@books.test", "West", "basic"),
]
#: two members changed, one new
MEMBER_MOVES = [
    (11, "Ada Quill", "ada@books.test", "Harbour", "basic"),
    (12, "Ben Marrow", "ben@books.test", "South", "gold"),
    (15, "Edda Stone", "edda@books.test", "Hill", "basic"),
]

READER_SCHEMA = "member_no int, full_name string, branch string, joined date"
READERS = [
    (1, "Fay", "North", dt.date(2021, 5, 3)),
    (2, "Gus", "South", dt.date(2021, 6, 9)),
    (3, "Hal", "East", dt.date(2021, 8, 21)),
    (4, "Ivy", "West", dt.date(2021, 9, 30)),
]
LOAN_SCHEMA = "loan_no int, member_no int, title string, fee int, taken date"
LOANS = [
    (901, 1, "Atlas", 40, dt.date(2022, 3, 2)),
    (902, 1, "Ballads", 15, dt.date(2022, 3, 7)),
    (903, 2, "Cookery", 25, dt.date(2022, 3, 14)),
    (904, 9, "Drama", 30, dt.date(2022, 3, 25)),
]
TITLE_SCHEMA = "title_no int, title string, shelf string"
TITLES = [(1, "Atlas", "maps"), (2, "Ballads", "verse"), (3, "Cookery", "home"), (4, "Drama", "verse")]
TERM_SCHEMA = "term_no int, first_day date, last_day date, term string"
TERMS = [
    (1, dt.date(2022, 3, 1), dt.date(2022, 3, 14), "first half"),
    (2, dt.date(2022, 3, 15), dt.date(2022, 3, 31), "second half"),
]

BASKET_SCHEMA = "order_id int, customer string, order_date date, order_status string"
BASKETS = [(7, "Uma", dt.date(2022, 1, 5), "paid"), (8, "Vic", dt.date(2022, 1, 6), "paid"), (9, "Wes", dt.date(2022, 1, 9), "open")]
LINE_SCHEMA = "order_id int, item string, qty int, price double"
LINES = [(7, "pen", 3, 4.0), (7, "ink", 1, 9.5), (8, "pad", 2, 6.25), (9, "pen", 1, 4.0), (9, "map", 4, 11.0)]
