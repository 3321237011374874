"""What several test modules share."""

import datetime

SMALL = "/root/testdata/sf0.001"


def seconds(text):
    return datetime.datetime.fromisoformat(text).replace(tzinfo=datetime.timezone.utc).timestamp()
