"""Schemas of the input files. The names and types are fixed values."""

OBSERVATION = (
    "station string, date string, observation string, value int, "
    "mflag string, qflag string, sflag string, obstime string"
)

COMMENT = (
    "archived boolean, author string, author_flair_css_class string, "
    "author_flair_text string, body string, controversiality bigint, "
    "created_utc string, distinguished string, downs bigint, edited string, "
    "gilded bigint, id string, link_id string, name string, parent_id string, "
    "retrieved_on bigint, score bigint, score_hidden boolean, subreddit string, "
    "subreddit_id string, ups bigint, month int"
)

PAGE_COUNT = "language string, title string, views bigint, size bigint"

ADJACENCY = "source string, dest string"

PATH = "node string, source string, distance int"

TMAX = (
    "station string, date date, latitude float, longitude float, "
    "elevation float, tmax float"
)

COLOUR = (
    "R int not null, G int not null, B int not null, "
    "word string not null, confidence string not null"
)
