import pytest

from postlane.functions.keys import with_key
from postlane.options import OptionError

HEX = "5fb4a18030154fe4b09a1dfe8075bc101dfe8075bc104fe4"


def key(df, option):
    return with_key(df, option).select("key_type", "key_text", "key_bytes", "key_error").first()


def test_no_key(make):
    assert tuple(key(make({}), None)) == (None, None, None, None)


def test_message_id_loses_its_prefix(make):
    row = key(make({"message_id": "ID:" + HEX}), "JMSMessageID")
    assert (row.key_type, row.key_text) == ("STRING", HEX)
    assert key(make({"message_id": "plain"}), "JMSMessageID").key_text == "plain"


@pytest.mark.parametrize("given,expected", [("verifycorrel", "verifycorrel"), ("ID:" + HEX, HEX)])
def test_correlation_id(make, given, expected):
    row = key(make({"correlation_id": given}), "JMSCorrelationID")
    assert (row.key_type, row.key_text) == ("STRING", expected)


def test_correlation_id_as_bytes(make):
    df = make({"correlation_id_bytes": b"verifycorrelbytes"}, {})
    rows = with_key(df, "JMSCorrelationIDAsBytes").orderBy("arrival_seq").collect()
    assert [bytes(rows[0].key_bytes), rows[1].key_bytes] == [b"verifycorrelbytes", None]
    assert {row.key_type for row in rows} == {"BYTES"}
    assert [row.key_error for row in rows] == [None, None]


def test_destination(make):
    assert key(make({}), "JMSDestination").key_text == "queue:///DEV.QUEUE.1"


@pytest.mark.parametrize("group", ["GROUP-A", None])
def test_group_id_may_be_null_but_stays_text(make, group):
    row = key(make({"group_id": group}), "JMSXGroupID")
    assert (row.key_type, row.key_text, row.key_error) == ("STRING", group, None)


@pytest.mark.parametrize(
    "option,column",
    [
        ("JMSMessageID", "message_id"),
        ("JMSCorrelationID", "correlation_id"),
        ("JMSDestination", "destination"),
    ],
)
def test_missing_id_is_an_error(make, option, column):
    row = key(make({column: None}), option)
    assert row.key_error["class"] == "MissingKeyField"


def test_unknown_option(make):
    with pytest.raises(OptionError):
        with_key(make({}), "JMSType")
