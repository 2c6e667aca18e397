import os

import fixtures
from strata import schemas
from strata.sources.store import TableStore
from strata.sources.tables import ONLINE_COLUMNS
from strata.streaming import stage_stream


def test_stream_stages_new_files_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    root = os.path.join(tmp_dir, "wh")
    ckpt = os.path.join(tmp_dir, "ckpt")
    fixtures.write(os.path.join(landing, "a.csv"), ONLINE_COLUMNS, fixtures.BATCH1_ONLINE)
    q = stage_stream(spark, landing, root, "online", checkpoint=ckpt)
    q.awaitTermination(300)
    st = TableStore(spark, root)
    assert st.read_appended("src_online_retail_sales", schemas.SRC_ONLINE).count() == 5
    # a second file: only its new fingerprints are staged; a replayed file adds nothing
    fixtures.write(os.path.join(landing, "b.csv"), ONLINE_COLUMNS, fixtures.BATCH2_ONLINE)
    q = stage_stream(spark, landing, root, "online", checkpoint=ckpt)
    q.awaitTermination(300)
    assert st.read_appended("src_online_retail_sales", schemas.SRC_ONLINE).count() == 7
