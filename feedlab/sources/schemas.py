"""Declared schemas; nothing is inferred."""

EVENTS = """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
            value DOUBLE, props STRING"""

FEED = """event_id BIGINT, user_id BIGINT, time TIMESTAMP_NTZ, action STRING, os STRING,
          gender INT, age INT, source STRING, exp_group INT"""

MESSAGES = """event_id BIGINT, user_id BIGINT, reciever_id BIGINT, time TIMESTAMP_NTZ,
              os STRING, gender INT, age INT"""

FEED_USER_DAY = """user_id BIGINT, event_date DATE, os STRING, gender INT, age INT,
                   views BIGINT, likes BIGINT"""

DAILY_SLICES = """event_date DATE, dimension STRING, dimension_value STRING, views BIGINT,
                  likes BIGINT, messages_sent BIGINT, messages_received BIGINT,
                  users_sent BIGINT, users_received BIGINT"""
