"""Fixed values.

Names, patterns and constants below are part of the data formats the job reads
and writes. They have to stay as they are for results to be right.
"""

# Technical columns of a record export, and the types they always get.
REPEAT_INSTRUMENT = "redcap_repeat_instrument"
REPEAT_INSTANCE = "redcap_repeat_instance"
BUILT_IN_TYPES = ((REPEAT_INSTRUMENT, "text"), (REPEAT_INSTANCE, "int"))

# Columns trimmed before filtering, and the ones the test-record split reads.
TRIMMED_COLUMNS = ("pi_firstname", "pi_lastname")
TITLE_COLUMN = "proposal_title2"
FIRST_NAME_COLUMN = "pi_firstname"
LAST_NAME_COLUMN = "pi_lastname"

# Checkbox columns are named <field>___<code>; a ticked one holds 1.
CHECKBOX_SEPARATOR = "___"
TICKED = "1"

# Columns <prefix><organization> hold reviewer names.
REVIEWER_PREFIX = "reviewer_name_"
REVIEWER_TABLE = "reviewer_organization"

# Code/label dimension, and the dictionary rows that list submitting members.
LABEL_TABLE = "name"
MEMBER_PATTERN = "^ctsa_[0-9]*$"
MEMBER_INDEX_START = 6
MEMBER_FIELD = "org_name"
MEMBER_TABLE = "Submitter"
MEMBER_COLUMN = "submitterInstitution"

# Academic titles that may follow a person name.
NAME_TITLES = ("MD", "M.D.", "PhD", "MPH", "MBBCH", "MSCE")
# Names that stand for themselves in both parts.
WHOLE_NAMES = ("unknown", "Pending")
# Where a name that does not parse is cut, in the order they are looked for.
NAME_CUT_AFTER = "-"
NAME_CUTS_BEFORE = (",", "/", "for")
