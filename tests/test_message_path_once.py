from tidelog.functions import records as R


def test_each_varint_is_decoded_once(spark):
    """A lambda evaluates each mention of a column again: the head and the step have one decoder each."""
    df = spark.createDataFrame([(bytearray(b"\x04\x02\x06ab"),), (bytearray(b"\x00x"),), (bytearray(b"\x04\x02"),), (None,)], "d binary")
    out = df.select(R.message_path("d").alias("m"))
    assert out._jdf.queryExecution().analyzed().toString().count("conv(hex(") == 2
    got = [r.m and (r.m.path, bytes(r.m.message)) for r in out.collect()]
    assert got == [([1, 3], b"ab"), ([0], b"x"), None, None]
