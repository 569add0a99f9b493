"""Column tables of the reports.

Everything in this file is a FIXED VALUE: the output names, the raw field names
and the output types are the contract of the published tables, and the order is
their column order.  One line per column:

    output name    raw field    type

Types: ``string`` (passed through), ``bigint``, ``int``, ``double``, ``date``,
``decimal`` (30,6), ``currency`` (micro units to units, double), ``criteria``
(filled in by each criteria report), ``lookup`` (the raw field column names the
location level whose resolved name is meant).
"""

CRITERIA = """
ad_group_name                       ad_group_name                                                string
ad_group_id                         ad_group_id                                                  bigint
ad_group_status                     ad_group_status                                              string
ad_network_type                     segments_ad_network_type                                     string
all_conversions                     metrics_all_conversions                                      double
approval_status                     ad_group_criterion_approval_status                           string
bid_modifier                        ad_group_criterion_bid_modifier                              double
campaign_id                         campaign_id                                                  bigint
campaign_name                       campaign_name                                                string
campaign_status                     campaign_status                                              string
clicks                              metrics_clicks                                               bigint
conversions                         metrics_conversions                                          double
cost                                metrics_cost_micros                                          currency
cpc_bid                             ad_group_criterion_effective_cpc_bid_micros                  bigint
cpc_bid_source                      ad_group_criterion_effective_cpc_bid_source                  string
creative_quality_score              ad_group_criterion_quality_info_creative_quality_score       string
criteria                            -                                                            criteria
criteria_type                       ad_group_criterion_type_                                     string
cross_device_conversions            metrics_cross_device_conversions                             double
customer_descriptive_name           customer_descriptive_name                                    string
device                              segments_device                                              string
external_customer_id                customer_id                                                  bigint
final_mobile_urls                   ad_group_criterion_final_mobile_urls                         string
final_urls                          ad_group_criterion_final_urls                                string
first_page_cpc                      ad_group_criterion_position_estimates_first_page_cpc_micros  bigint
first_position_cpc                  ad_group_criterion_position_estimates_first_position_cpc_micros bigint
id                                  ad_group_criterion_criterion_id                              bigint
impressions                         metrics_impressions                                          bigint
post_click_quality_score            ad_group_criterion_quality_info_post_click_quality_score     string
quality_score                       ad_group_criterion_quality_info_quality_score                bigint
search_predicted_ctr                ad_group_criterion_quality_info_search_predicted_ctr         string
status                              ad_group_criterion_status                                    string
top_of_page_cpc                     ad_group_criterion_position_estimates_top_of_page_cpc_micros bigint
tracking_url_template               ad_group_criterion_tracking_url_template                     string
url_custom_parameters               ad_group_criterion_url_custom_parameters                     string
view_through_conversions            metrics_view_through_conversions                             int
report_dt                           segments_date                                                date
data_date                           segments_date                                                string
"""

CRITERIA_CONV = """
ad_network_type                     segments_ad_network_type                                     string
ad_group_id                         ad_group_id                                                  bigint
conversion_category_name            segments_conversion_action_category                          string
conversion_type_name                segments_conversion_action_name                              string
conversions                         metrics_conversions                                          double
report_dt                           segments_date                                                date
device                              segments_device                                              string
id                                  ad_group_criterion_criterion_id                              bigint
criteria_type                       ad_group_criterion_type_                                     string
external_customer_id                customer_id                                                  bigint
data_date                           segments_date                                                string
"""

AD_CONV = """
ad_network_type                     segments_ad_network_type                                     string
ad_group_id                         ad_group_id                                                  bigint
conversion_category_name            segments_conversion_action_category                          string
conversion_type_name                segments_conversion_action_name                              string
conversions                         metrics_conversions                                          double
device                              segments_device                                              string
external_customer_id                customer_id                                                  bigint
report_dt                           segments_date                                                date
id                                  ad_group_ad_ad_id                                            bigint
data_date                           segments_date                                                string
"""

CAMPAIGN = """
account_currency_code               customer_currency_code                                       string
account_time_zone                   customer_time_zone                                           string
ad_network_type                     segments_ad_network_type                                     string
advertising_channel_subtype         campaign_advertising_channel_sub_type                        string
advertising_channel_type            campaign_advertising_channel_type                            string
amount                              campaign_budget_amount_micros                                bigint
base_campaignid                     campaign_base_campaign                                       string
bidding_strategy_id                 campaign_bidding_strategy                                    string
bidding_strategy_name               bidding_strategy_name                                        string
bidding_strategy_type               campaign_bidding_strategy_type                               string
budget_id                           campaign_campaign_budget                                     string
campaign_id                         campaign_id                                                  bigint
campaign_name                       campaign_name                                                string
campaign_status                     campaign_status                                              string
campaign_trial_type                 campaign_experiment_type                                     string
account_descriptive_name            customer_descriptive_name                                    string
day_of_week                         segments_day_of_week                                         string
device                              segments_device                                              string
end_date                            campaign_end_date                                            string
external_customer_id                customer_id                                                  bigint
final_url_suffix                    campaign_final_url_suffix                                    string
has_recommended_budget              campaign_budget_has_recommended_budget                       string
is_budget_explicitly_shared         campaign_budget_explicitly_shared                            string
maximize_conversion_value_target_roas campaign_maximize_conversion_value_target_roas               double
month                               segments_month                                               string
period                              campaign_budget_period                                       string
quarter                             segments_quarter                                             string
recommended_budget_amount           campaign_budget_recommended_budget_amount_micros             bigint
serving_status                      campaign_serving_status                                      string
start_date                          campaign_start_date                                          string
total_amount                        campaign_budget_total_amount_micros                          bigint
tracking_url_template               campaign_tracking_url_template                               string
url_custom_parameters               campaign_url_custom_parameters                               string
week                                segments_week                                                string
year                                segments_year                                                string
report_dt                           segments_date                                                date
absolute_top_impression_percentage  metrics_absolute_top_impression_percentage                   double
active_view_cpm                     metrics_active_view_cpm                                      double
active_view_ctr                     metrics_active_view_ctr                                      double
active_view_impressions             metrics_active_view_impressions                              bigint
active_view_measurability           metrics_active_view_measurability                            double
active_view_measurable_cost         metrics_active_view_measurable_cost_micros                   bigint
active_view_measurable_impressions  metrics_active_view_measurable_impressions                   bigint
active_view_view_ability            metrics_active_view_viewability                              double
all_conversions                     metrics_all_conversions                                      double
all_conversions_by_conversion_date  metrics_all_conversions_by_conversion_date                   double
all_conversions_from_interactions_rate metrics_all_conversions_from_interactions_rate               double
all_conversion_value                metrics_all_conversions_value                                double
all_conversions_value_by_conversion_date metrics_all_conversions_value_by_conversion_date             double
average_cost                        metrics_average_cost                                         double
average_cpc                         metrics_average_cpc                                          double
average_cpe                         metrics_average_cpe                                          double
average_cpm                         metrics_average_cpm                                          decimal
average_cpv                         metrics_average_cpv                                          double
clicks                              metrics_clicks                                               bigint
content_budget_lost_impression_share metrics_content_budget_lost_impression_share                 double
content_impression_share            metrics_content_impression_share                             double
content_rank_lost_impression_share  metrics_content_rank_lost_impression_share                   double
conversions                         metrics_conversions                                          double
conversions_by_conversion_date      metrics_conversions_by_conversion_date                       double
conversions_from_interactions_rate  metrics_conversions_from_interactions_rate                   double
conversion_value                    metrics_conversions_value                                    double
conversions_value_by_conversion_date metrics_conversions_value_by_conversion_date                 double
cost                                metrics_cost_micros                                          currency
cost_per_all_conversions            metrics_cost_per_all_conversions                             double
cost_per_conversion                 metrics_cost_per_conversion                                  double
cost_per_current_model_attributed_conversion metrics_cost_per_current_model_attributed_conversion         double
cross_device_conversions            metrics_cross_device_conversions                             double
ctr                                 metrics_ctr                                                  double
current_model_attributed_conversions metrics_current_model_attributed_conversions                 double
current_model_attributed_conversions_from_interactions_rate metrics_current_model_attributed_conversions_from_interactions_rate double
current_model_attributed_conversions_from_interactions_value_per_interaction metrics_current_model_attributed_conversions_from_interactions_value_per_interaction double
current_model_attributed_conversion_value metrics_current_model_attributed_conversions_value           double
current_model_attributed_conversions_value_per_cost metrics_current_model_attributed_conversions_value_per_cost  double
engagement_rate                     metrics_engagement_rate                                      double
engagements                         metrics_engagements                                          bigint
gmail_forwards                      metrics_gmail_forwards                                       int
gmail_saves                         metrics_gmail_saves                                          int
gmail_secondary_clicks              metrics_gmail_secondary_clicks                               int
impressions                         metrics_impressions                                          bigint
interaction_types                   metrics_interaction_event_types                              string
interaction_rate                    metrics_interaction_rate                                     double
interactions                        metrics_interactions                                         bigint
search_absolute_top_impression_share metrics_search_absolute_top_impression_share                 double
search_budget_lost_absolute_top_impression_share metrics_search_budget_lost_absolute_top_impression_share     double
search_budget_lost_impression_share metrics_search_budget_lost_impression_share                  double
search_budget_lost_top_impression_share metrics_search_budget_lost_top_impression_share              double
search_click_share                  metrics_search_click_share                                   double
search_exact_match_impression_share metrics_search_exact_match_impression_share                  double
search_impression_share             metrics_search_impression_share                              double
search_rank_lost_absolute_top_impression_share metrics_search_rank_lost_absolute_top_impression_share       double
search_rank_lost_impression_share   metrics_search_rank_lost_impression_share                    double
search_rank_lost_top_impression_share metrics_search_rank_lost_top_impression_share                double
search_top_impression_share         metrics_search_top_impression_share                          double
top_impression_percentage           metrics_top_impression_percentage                            double
value_per_all_conversions           metrics_value_per_all_conversions                            double
value_per_all_conversions_by_conversion_date metrics_value_per_all_conversions_by_conversion_date         double
value_per_conversion                metrics_value_per_conversion                                 double
value_per_conversions_by_conversion_date metrics_value_per_conversions_by_conversion_date             double
value_per_current_model_attributed_conversion metrics_value_per_current_model_attributed_conversion        double
video_quartile100_rate              metrics_video_quartile_p100_rate                             double
video_quartile25_rate               metrics_video_quartile_p25_rate                              double
video_quartile50_rate               metrics_video_quartile_p50_rate                              double
video_quartile75_rate               metrics_video_quartile_p75_rate                              double
video_view_rate                     metrics_video_view_rate                                      double
video_views                         metrics_video_views                                          int
view_through_conversions            metrics_view_through_conversions                             int
data_date                           segments_date                                                string
"""

ADS = """
account_descriptive_name            customer_descriptive_name                                    string
ad_group_id                         ad_group_id                                                  bigint
ad_group_name                       ad_group_name                                                string
ad_group_status                     ad_group_status                                              string
ad_network_type                     segments_ad_network_type                                     string
campaign_id                         campaign_id                                                  bigint
campaign_name                       campaign_name                                                string
campaign_status                     campaign_status                                              string
creative_approval_status            ad_group_ad_policy_summary_approval_status                   string
creative_final_mobile_urls          ad_group_ad_ad_final_mobile_urls                             string
creative_final_urls                 ad_group_ad_ad_final_urls                                    string
creative_tracking_url_template      ad_group_ad_ad_tracking_url_template                         string
creative_url_custom_parameters      ad_group_ad_ad_url_custom_parameters                         string
report_dt                           segments_date                                                date
description                         ad_group_ad_ad_expanded_text_ad_description                  string
description1                        ad_group_ad_ad_text_ad_description1                          string
description2                        ad_group_ad_ad_text_ad_description2                          string
device                              segments_device                                              string
device_preference                   ad_group_ad_ad_device_preference                             string
display_url                         ad_group_ad_ad_display_url                                   string
external_customer_id                customer_id                                                  bigint
headline                            ad_group_ad_ad_text_ad_headline                              string
headline_part1                      ad_group_ad_ad_expanded_text_ad_headline_part1               string
headline_part2                      ad_group_ad_ad_expanded_text_ad_headline_part2               string
id                                  ad_group_ad_ad_id                                            bigint
status                              ad_group_ad_status                                           string
responsive_search_ad_headlines      ad_group_ad_ad_responsive_search_ad_headlines                string
responsive_search_ad_descriptions   ad_group_ad_ad_responsive_search_ad_descriptions             string
expanded_text_ad_headline_part3     ad_group_ad_ad_expanded_text_ad_headline_part3               string
expanded_text_ad_description2       ad_group_ad_ad_expanded_text_ad_description2                 string
absolute_top_impression_prc         metrics_absolute_top_impression_percentage                   double
active_view_cpm                     metrics_active_view_cpm                                      double
active_view_ctr                     metrics_active_view_ctr                                      double
active_view_impressions             metrics_active_view_impressions                              bigint
active_view_measurability           metrics_active_view_measurability                            double
active_view_measurable_cost         metrics_active_view_measurable_cost_micros                   bigint
active_view_measurable_impressions  metrics_active_view_measurable_impressions                   bigint
active_view_view_ability            metrics_active_view_viewability                              double
all_conversions                     metrics_all_conversions                                      double
all_conversions_by_conversion_date  metrics_all_conversions_by_conversion_date                   double
all_conversions_from_interactions_rate metrics_all_conversions_from_interactions_rate               double
all_conversion_value                metrics_all_conversions_value                                double
all_conversions_value_by_conversion_date metrics_all_conversions_value_by_conversion_date             double
average_cost                        metrics_average_cost                                         double
average_cpc                         metrics_average_cpc                                          double
average_cpe                         metrics_average_cpe                                          double
average_cpm                         metrics_average_cpm                                          decimal
average_cpv                         metrics_average_cpv                                          double
clicks                              metrics_clicks                                               bigint
conversions                         metrics_conversions                                          double
conversions_by_conversion_date      metrics_conversions_by_conversion_date                       double
conversions_from_interactions_rate  metrics_conversions_from_interactions_rate                   double
conversion_value                    metrics_conversions_value                                    double
conversions_value_by_conversion_date metrics_conversions_value_by_conversion_date                 double
cost                                metrics_cost_micros                                          currency
cost_per_all_conversions            metrics_cost_per_all_conversions                             double
cost_per_conversion                 metrics_cost_per_conversion                                  double
cost_per_current_model_attributed_conversion metrics_cost_per_current_model_attributed_conversion         double
cross_device_conversions            metrics_cross_device_conversions                             double
ctr                                 metrics_ctr                                                  double
current_model_attributed_conversions metrics_current_model_attributed_conversions                 double
current_model_attributed_conversion_value metrics_current_model_attributed_conversions_value           double
engagement_rate                     metrics_engagement_rate                                      double
engagements                         metrics_engagements                                          bigint
gmail_forwards                      metrics_gmail_forwards                                       int
gmail_saves                         metrics_gmail_saves                                          int
gmail_secondary_clicks              metrics_gmail_secondary_clicks                               int
impressions                         metrics_impressions                                          bigint
interaction_types                   metrics_interaction_event_types                              string
interaction_rate                    metrics_interaction_rate                                     double
interactions                        metrics_interactions                                         bigint
top_impression_prc                  metrics_top_impression_percentage                            double
value_per_all_conversions           metrics_value_per_all_conversions                            double
value_per_all_conversions_by_conversion_date metrics_value_per_all_conversions_by_conversion_date         double
value_per_conversion                metrics_value_per_conversion                                 double
value_per_conversions_by_conversion_date metrics_value_per_conversions_by_conversion_date             double
value_per_current_model_attributed_conversion metrics_value_per_current_model_attributed_conversion        double
video_quartile100_rate              metrics_video_quartile_p100_rate                             double
video_quartile25_rate               metrics_video_quartile_p25_rate                              double
video_quartile50_rate               metrics_video_quartile_p50_rate                              double
video_quartile75_rate               metrics_video_quartile_p75_rate                              double
video_view_rate                     metrics_video_view_rate                                      double
video_views                         metrics_video_views                                          int
view_through_conversions            metrics_view_through_conversions                             int
data_date                           segments_date                                                string
"""

KEYWORD = """
criteria                            ad_group_criterion_keyword_text                              string
id                                  ad_group_criterion_criterion_id                              bigint
is_negative                         ad_group_criterion_negative                                  string
keyword_match_type                  ad_group_criterion_keyword_match_type                        string
status                              ad_group_criterion_status                                    string
final_urls                          ad_group_criterion_final_urls                                string
account_descriptive_name            customer_descriptive_name                                    string
external_customer_id                customer_id                                                  bigint
ad_group_id                         ad_group_id                                                  bigint
ad_group_name                       ad_group_name                                                string
ad_group_status                     ad_group_status                                              string
campaign_id                         campaign_id                                                  bigint
campaign_name                       campaign_name                                                string
campaign_status                     campaign_status                                              string
report_dt                           segments_date                                                date
all_conversions                     metrics_all_conversions                                      double
approval_status                     ad_group_criterion_approval_status                           string
top_impression_prc                  metrics_top_impression_percentage                            double
absolute_top_impression_prc         metrics_absolute_top_impression_percentage                   double
average_page_views                  metrics_average_page_views                                   double
average_cost                        metrics_average_cost                                         double
average_cpc                         metrics_average_cpc                                          double
average_time_on_site                metrics_average_time_on_site                                 double
bounce_rate                         metrics_bounce_rate                                          double
impressions                         metrics_impressions                                          bigint
clicks                              metrics_clicks                                               bigint
conversions                         metrics_conversions                                          double
cost                                metrics_cost_micros                                          currency
quality_score                       ad_group_criterion_quality_info_quality_score                int
creative_quality_score              ad_group_criterion_quality_info_creative_quality_score       int
historical_quality_score            metrics_historical_quality_score                             int
historical_creative_quality_score   metrics_historical_creative_quality_score                    int
historical_landing_page_quality_score metrics_historical_landing_page_quality_score                int
active_view_cpm                     metrics_active_view_cpm                                      double
active_view_ctr                     metrics_active_view_ctr                                      double
active_view_impressions             metrics_active_view_impressions                              bigint
active_view_measurability           metrics_active_view_measurability                            double
active_view_measurable_cost         metrics_active_view_measurable_cost_micros                   bigint
active_view_measurable_impressions  metrics_active_view_measurable_impressions                   bigint
active_view_view_ability            metrics_active_view_viewability                              double
all_conversions_from_interactions_rate metrics_all_conversions_from_interactions_rate               double
all_conversion_value                metrics_all_conversions_value                                double
average_cpe                         metrics_average_cpe                                          double
average_cpm                         metrics_average_cpm                                          decimal
average_cpv                         metrics_average_cpv                                          double
conversions_from_interactions_rate  metrics_conversions_from_interactions_rate                   double
conversion_value                    metrics_conversions_value                                    double
cost_per_all_conversions            metrics_cost_per_all_conversions                             double
cost_per_conversion                 metrics_cost_per_conversion                                  double
cost_per_current_model_attributed_conversion metrics_cost_per_current_model_attributed_conversion         double
cross_device_conversions            metrics_cross_device_conversions                             double
ctr                                 metrics_ctr                                                  double
current_model_attributed_conversion_value metrics_current_model_attributed_conversions_value           double
current_model_attributed_conversions metrics_current_model_attributed_conversions                 double
engagement_rate                     metrics_engagement_rate                                      double
engagements                         metrics_engagements                                          bigint
gmail_forwards                      metrics_gmail_forwards                                       int
gmail_saves                         metrics_gmail_saves                                          int
gmail_secondary_clicks              metrics_gmail_secondary_clicks                               int
historical_search_predicted_ctr     metrics_historical_search_predicted_ctr                      string
interaction_rate                    metrics_interaction_rate                                     double
interaction_types                   metrics_interaction_event_types                              string
interactions                        metrics_interactions                                         bigint
percent_new_visitors                metrics_percent_new_visitors                                 double
search_absolute_top_impression_share metrics_search_absolute_top_impression_share                 double
search_budget_lost_absolute_top_impression_share metrics_search_budget_lost_absolute_top_impression_share     double
search_budget_lost_top_impression_share metrics_search_budget_lost_top_impression_share              double
search_exact_match_impression_share metrics_search_exact_match_impression_share                  double
search_impression_share             metrics_search_impression_share                              double
search_rank_lost_absolute_top_impression_share metrics_search_rank_lost_absolute_top_impression_share       double
search_rank_lost_impression_share   metrics_search_rank_lost_impression_share                    double
search_rank_lost_top_impression_share metrics_search_rank_lost_top_impression_share                double
value_per_all_conversions           metrics_value_per_all_conversions                            double
value_per_conversion                metrics_value_per_conversion                                 double
value_per_current_model_attributed_conversion metrics_value_per_current_model_attributed_conversion        double
video_quartile100_rate              metrics_video_quartile_p100_rate                             double
video_quartile25_rate               metrics_video_quartile_p25_rate                              double
video_quartile50_rate               metrics_video_quartile_p50_rate                              double
video_quartile75_rate               metrics_video_quartile_p75_rate                              double
video_view_rate                     metrics_video_view_rate                                      double
video_views                         metrics_video_views                                          int
view_through_conversions            metrics_view_through_conversions                             int
data_date                           segments_date                                                string
"""

GEO = """
account_currency_code               customer_currency_code                                       string
account_descriptive_name            customer_descriptive_name                                    string
account_time_zone                   customer_time_zone                                           string
ad_group_id                         ad_group_id                                                  bigint
ad_group_name                       ad_group_name                                                string
ad_group_status                     ad_group_status                                              string
ad_network_type                     segments_ad_network_type                                     string
all_conversion_rate                 metrics_all_conversions_from_interactions_rate               double
all_conversions                     metrics_all_conversions                                      double
all_conversion_value                metrics_all_conversions_value                                double
average_cost                        metrics_average_cost                                         double
average_cpc                         metrics_average_cpc                                          double
average_cpm                         metrics_average_cpm                                          decimal
average_cpv                         metrics_average_cpv                                          double
campaign_id                         campaign_id                                                  bigint
campaign_name                       campaign_name                                                string
campaign_status                     campaign_status                                              string
clicks                              metrics_clicks                                               bigint
conversions_rate                    metrics_conversions_from_interactions_rate                   double
conversions                         metrics_conversions                                          double
conversion_value                    metrics_conversions_value                                    double
cost                                metrics_cost_micros                                          currency
cost_per_all_conversions            metrics_cost_per_all_conversions                             double
cost_per_conversion                 metrics_cost_per_conversion                                  double
cross_device_conversions            metrics_cross_device_conversions                             double
ctr                                 metrics_ctr                                                  double
day_of_week                         segments_day_of_week                                         string
device                              segments_device                                              string
external_customer_id                customer_id                                                  bigint
impressions                         metrics_impressions                                          bigint
interaction_rate                    metrics_interaction_rate                                     double
interactions                        metrics_interactions                                         bigint
interaction_types                   metrics_interaction_event_types                              string
location_type                       geographic_view_location_type                                string
month                               segments_month                                               string
quarter                             segments_quarter                                             string
value_per_all_conversions           metrics_value_per_all_conversions                            double
value_per_conversion                metrics_value_per_conversion                                 double
video_view_rate                     metrics_video_view_rate                                      double
video_views                         metrics_video_views                                          bigint
view_through_conversions            metrics_view_through_conversions                             bigint
week                                segments_week                                                string
year                                segments_year                                                string
report_dt                           segments_date                                                date
city_criteria_id                    segments_geo_target_city                                     string
city_criteria_name                  city                                                         lookup
country_criteria_id                 geographic_view_country_criterion_id                         string
country_criteria_name               country                                                      lookup
metro_criteria_id                   segments_geo_target_metro                                    string
metro_criteria_name                 metro                                                        lookup
most_specific_criteria_id           segments_geo_target_most_specific_location                   string
most_specific_criteria_name         most_specific                                                lookup
region_criteria_id                  segments_geo_target_region                                   string
region_criteria_name                region                                                       lookup
data_date                           segments_date                                                string
"""

SEARCH_QUERY = """
currency_code                       customer_currency_code                                       string
descriptive_name                    customer_descriptive_name                                    string
time_zone                           customer_time_zone                                           string
ad_group_id                         ad_group_id                                                  bigint
ad_group_name                       ad_group_name                                                string
ad_group_status                     ad_group_status                                              string
ad_network_type                     segments_ad_network_type                                     string
all_conversions_from_interactions_rate metrics_all_conversions_from_interactions_rate               double
all_conversions                     metrics_all_conversions                                      double
all_conversions_value               metrics_all_conversions_value                                double
average_cost                        metrics_average_cost                                         double
average_cpc                         metrics_average_cpc                                          double
average_cpm                         metrics_average_cpm                                          double
top_impression_percentage           metrics_top_impression_percentage                            double
absolute_top_impression_percentage  metrics_absolute_top_impression_percentage                   double
campaign_id                         campaign_id                                                  bigint
campaign_name                       campaign_name                                                string
campaign_status                     campaign_status                                              string
clicks                              metrics_clicks                                               bigint
conversions                         metrics_conversions                                          double
cost_micros                         metrics_cost_micros                                          bigint
ad_group_ad_ad_id                   ad_group_ad_ad_id                                            bigint
cross_device_conversions            metrics_cross_device_conversions                             double
ctr                                 metrics_ctr                                                  double
report_dt                           segments_date                                                date
day_of_week                         segments_day_of_week                                         string
device                              segments_device                                              string
external_customer_id                customer_id                                                  bigint
ad_group_ad_ad_final_urls           ad_group_ad_ad_final_urls                                    string
impressions                         metrics_impressions                                          bigint
month                               segments_month                                               string
quarter                             segments_quarter                                             string
search_term_view_search_term        search_term_view_search_term                                 string
search_term_match_type              segments_search_term_match_type                              string
search_term_view_status             search_term_view_status                                      string
ad_group_ad_ad_tracking_url_template ad_group_ad_ad_tracking_url_template                         string
week                                segments_week                                                string
year                                segments_year                                                string
conversions_from_interactions_rate  metrics_conversions_from_interactions_rate                   double
conversions_value                   metrics_conversions_value                                    double
cost_per_all_conversions            metrics_cost_per_all_conversions                             double
cost_per_conversion                 metrics_cost_per_conversion                                  double
interaction_rate                    metrics_interaction_rate                                     double
interaction_event_types             metrics_interaction_event_types                              string
interactions                        metrics_interactions                                         bigint
value_per_all_conversions           metrics_value_per_all_conversions                            double
value_per_conversion                metrics_value_per_conversion                                 double
view_through_conversions            metrics_view_through_conversions                             bigint
data_date                           segments_date                                                string
"""

KEYWORDLESS = """
currency                            customer_currency_code                                       string
account                             customer_descriptive_name                                    string
time_zone                           customer_time_zone                                           string
ad_group_id                         ad_group_id                                                  bigint
ad_group                            ad_group_name                                                string
ad_group_state                      ad_group_status                                              string
all_conv_rate                       metrics_all_conversions_from_interactions_rate               double
all_conv                            metrics_all_conversions                                      double
all_conv_value                      metrics_all_conversions_value                                double
avg_cpc                             metrics_average_cpc                                          double
avg_cpm                             metrics_average_cpm                                          double
campaign_id                         campaign_id                                                  bigint
campaign                            campaign_name                                                string
campaign_state                      campaign_status                                              string
clicks                              metrics_clicks                                               bigint
conv_rate                           metrics_conversions_from_interactions_rate                   double
conversions                         metrics_conversions                                          double
cost                                metrics_cost_micros                                          bigint
cost_all_conv                       metrics_cost_per_all_conversions                             double
cost_conv                           metrics_cost_per_conversion                                  double
keyword_id                          segments_webpage                                             string
cross_device_conv                   metrics_cross_device_conversions                             double
ctr                                 metrics_ctr                                                  double
client_name                         customer_descriptive_name                                    string
day                                 segments_date                                                date
customer_id                         customer_id                                                  bigint
impressions                         metrics_impressions                                          bigint
dynamically_generated_headline      dynamic_search_ads_search_term_view_headline                 string
search_term                         dynamic_search_ads_search_term_view_search_term              string
url                                 dynamic_search_ads_search_term_view_landing_page             string
value_all_conv                      metrics_value_per_all_conversions                            double
value_conv                          metrics_value_per_conversion                                 double
data_date                           segments_date                                                string
"""

PAID_ORGANIC = """
currency_code                       customer_currency_code                                       string
descriptive_name                    customer_descriptive_name                                    string
time_zone                           customer_time_zone                                           string
group_id                            ad_group_id                                                  bigint
ad_group_name                       ad_group_name                                                string
ad_group_status                     ad_group_status                                              string
average_cpc                         metrics_average_cpc                                          double
campaign_id                         campaign_id                                                  bigint
campaign_name                       campaign_name                                                string
campaign_status                     campaign_status                                              string
clicks                              metrics_clicks                                               bigint
combined_ads_organic_clicks         metrics_combined_clicks                                      bigint
combined_ads_organic_clicks_per_query metrics_combined_clicks_per_query                            double
combined_ads_organic_queries        metrics_combined_queries                                     bigint
ctr                                 metrics_ctr                                                  double
report_dt                           segments_date                                                date
day_of_week                         segments_day_of_week                                         string
external_customer_id                customer_id                                                  bigint
impressions                         metrics_impressions                                          bigint
month                               segments_month                                               string
organic_clicks                      metrics_organic_clicks                                       bigint
organic_clicks_per_query            metrics_organic_clicks_per_query                             double
organic_impressions                 metrics_organic_impressions                                  bigint
organic_impressions_per_query       metrics_organic_impressions_per_query                        double
organic_queries                     metrics_organic_queries                                      bigint
quarter                             segments_quarter                                             string
search_query                        paid_organic_search_term_view_search_term                    string
serp_type                           segments_search_engine_results_page_type                     string
week                                segments_week                                                string
year                                segments_year                                                string
data_date                           segments_date                                                string
"""

# Inserted after approval_status in the webpage and keyword criteria reports.
CRITERIA_WIDE_EXTRA = """
top_impression_prc                  metrics_top_impression_percentage                            double
absolute_top_impression_prc         metrics_absolute_top_impression_percentage                   double
"""

# Criterion type and the raw field that holds its criteria text.
AUDIENCE_CHOICES = (
    ("USER_LIST", "ad_group_criterion_user_list_user_list"),
    ("USER_INTEREST", "ad_group_criterion_user_interest_user_interest_category"),
    ("CUSTOM_INTENT", "ad_group_criterion_custom_intent_custom_intent"),
    ("CUSTOM_AUDIENCE", "ad_group_criterion_custom_audience_custom_audience"),
)
PLACEMENT_CHOICES = (
    ("PLACEMENT", "ad_group_criterion_placement_url"),
    ("MOBILE_APP_CATEGORY", "ad_group_criterion_mobile_app_category_mobile_app_category_constant"),
    ("MOBILE_APPLICATION", "ad_group_criterion_mobile_application_app_id"),
    ("YOUTUBE_CHANNEL", "ad_group_criterion_youtube_channel_channel_id"),
    ("YOUTUBE_VIDEO", "ad_group_criterion_youtube_video_video_id"),
)

# Raw fields that hold the location of a row, by level.  All but the country are
# resource names: a prefix of 19 characters, then the id.
LOCATION_FIELDS = {
    "city": "segments_geo_target_city",
    "country": "geographic_view_country_criterion_id",
    "metro": "segments_geo_target_metro",
    "most_specific": "segments_geo_target_most_specific_location",
    "region": "segments_geo_target_region",
}
LOCATION_PREFIX_LENGTH = 19


def raw_name(path: str) -> str:
    """Raw column of a dotted record field; a last part ``type`` becomes ``type_``."""
    name = path.replace(".", "_")
    return name + "_" if path.split(".")[-1] == "type" else name


# FIXED VALUES: the fields that the feeds fetch, by the part of the record they belong to.
RECORD_FIELDS = {
    "ad_group": "id name status",
    "ad_group_ad": """
        ad.device_preference ad.display_url ad.expanded_text_ad.description ad.expanded_text_ad.description2
        ad.expanded_text_ad.headline_part1 ad.expanded_text_ad.headline_part2 ad.expanded_text_ad.headline_part3
        ad.final_mobile_urls ad.final_urls ad.id ad.responsive_search_ad.descriptions
        ad.responsive_search_ad.headlines ad.text_ad.description1 ad.text_ad.description2 ad.text_ad.headline
        ad.tracking_url_template ad.url_custom_parameters policy_summary.approval_status status
    """,
    "ad_group_criterion": """
        age_range.type approval_status bid_modifier criterion_id custom_audience.custom_audience
        custom_intent.custom_intent effective_cpc_bid_micros effective_cpc_bid_source final_mobile_urls final_urls
        gender.type income_range.type keyword.match_type keyword.text
        mobile_app_category.mobile_app_category_constant mobile_application.app_id negative parental_status.type
        placement.url position_estimates.first_page_cpc_micros position_estimates.first_position_cpc_micros
        position_estimates.top_of_page_cpc_micros quality_info.creative_quality_score
        quality_info.post_click_quality_score quality_info.quality_score quality_info.search_predicted_ctr status
        topic.path tracking_url_template type url_custom_parameters user_interest.user_interest_category
        user_list.user_list webpage.criterion_name youtube_channel.channel_id youtube_video.video_id
    """,
    "bidding_strategy": "name",
    "campaign": """
        advertising_channel_sub_type advertising_channel_type base_campaign bidding_strategy bidding_strategy_type
        campaign_budget end_date experiment_type final_url_suffix id manual_cpc.enhanced_cpc_enabled
        maximize_conversion_value.target_roas name percent_cpc.enhanced_cpc_enabled serving_status start_date status
        tracking_url_template url_custom_parameters
    """,
    "campaign_budget": """
        amount_micros explicitly_shared has_recommended_budget period recommended_budget_amount_micros
        total_amount_micros
    """,
    "customer": "currency_code descriptive_name id time_zone",
    "dynamic_search_ads_search_term_view": "headline landing_page search_term",
    "geographic_view": "country_criterion_id location_type",
    "metrics": """
        absolute_top_impression_percentage active_view_cpm active_view_ctr active_view_impressions
        active_view_measurability active_view_measurable_cost_micros active_view_measurable_impressions
        active_view_viewability all_conversions all_conversions_by_conversion_date
        all_conversions_from_interactions_rate all_conversions_value all_conversions_value_by_conversion_date
        average_cost average_cpc average_cpe average_cpm average_cpv average_page_views average_time_on_site
        bounce_rate clicks combined_clicks combined_clicks_per_query combined_queries
        content_budget_lost_impression_share content_impression_share content_rank_lost_impression_share conversions
        conversions_by_conversion_date conversions_from_interactions_rate conversions_value
        conversions_value_by_conversion_date cost_micros cost_per_all_conversions cost_per_conversion
        cost_per_current_model_attributed_conversion cross_device_conversions ctr
        current_model_attributed_conversions current_model_attributed_conversions_from_interactions_rate
        current_model_attributed_conversions_from_interactions_value_per_interaction
        current_model_attributed_conversions_value current_model_attributed_conversions_value_per_cost
        engagement_rate engagements gmail_forwards gmail_saves gmail_secondary_clicks
        historical_creative_quality_score historical_landing_page_quality_score historical_quality_score
        historical_search_predicted_ctr impressions interaction_event_types interaction_rate interactions
        organic_clicks organic_clicks_per_query organic_impressions organic_impressions_per_query organic_queries
        percent_new_visitors search_absolute_top_impression_share search_budget_lost_absolute_top_impression_share
        search_budget_lost_impression_share search_budget_lost_top_impression_share search_click_share
        search_exact_match_impression_share search_impression_share search_rank_lost_absolute_top_impression_share
        search_rank_lost_impression_share search_rank_lost_top_impression_share search_top_impression_share
        top_impression_percentage value_per_all_conversions value_per_all_conversions_by_conversion_date
        value_per_conversion value_per_conversions_by_conversion_date value_per_current_model_attributed_conversion
        video_quartile_p100_rate video_quartile_p25_rate video_quartile_p50_rate video_quartile_p75_rate
        video_view_rate video_views view_through_conversions
    """,
    "paid_organic_search_term_view": "search_term",
    "search_term_view": "search_term status",
    "segments": """
        ad_network_type conversion_action_category conversion_action_name date day_of_week device geo_target_city
        geo_target_metro geo_target_most_specific_location geo_target_region month quarter
        search_engine_results_page_type search_term_match_type webpage week year
    """,
}
FETCHED_FIELDS = frozenset(raw_name(f"{part}.{field}") for part, fields in RECORD_FIELDS.items() for field in fields.split())

# Record fields that arrive as enum codes, and the enum that names the codes.
ENUM_FIELDS = {
    "campaign.status": "CampaignStatusEnum",
    "metrics.historical_search_predicted_ctr": "QualityScoreBucketEnum",
    "ad_group.status": "AdGroupStatusEnum",
    "ad_group_ad.status": "AdGroupAdStatusEnum",
    "segments.device": "DeviceEnum",
    "ad_group_ad.ad.device_preference": "DeviceEnum",
    "campaign.bidding_strategy_type": "BiddingStrategyTypeEnum",
    "segments.ad_network_type": "AdNetworkTypeEnum",
    "campaign.advertising_channel_sub_type": "AdvertisingChannelSubTypeEnum",
    "campaign.advertising_channel_type": "AdvertisingChannelTypeEnum",
    "campaign.experiment_type": "CampaignExperimentTypeEnum",
    "segments.day_of_week": "DayOfWeekEnum",
    "campaign_budget.period": "BudgetPeriodEnum",
    "campaign.serving_status": "CampaignServingStatusEnum",
    "ad_group_ad.policy_summary.approval_status": "PolicyApprovalStatusEnum",
    "segments.conversion_action_category": "ConversionActionCategoryEnum",
    "ad_group_criterion.approval_status": "AdGroupCriterionApprovalStatusEnum",
    "ad_group_criterion.status": "AdGroupCriterionStatusEnum",
    "ad_group_criterion.keyword.match_type": "KeywordMatchTypeEnum",
    "geographic_view.location_type": "GeoTargetingTypeEnum",
    "segments.search_engine_results_page_type": "SearchEngineResultsPageTypeEnum",
    "segments.search_term_match_type": "SearchTermMatchTypeEnum",
    "search_term_view.status": "SearchTermTargetingStatusEnum",
    "ad_group_criterion.effective_cpc_bid_source": "BiddingSourceEnum",
    "ad_group_criterion.quality_info.creative_quality_score": "QualityScoreBucketEnum",
    "ad_group_criterion.age_range.type": "AgeRangeTypeEnum",
    "ad_group_criterion.type": "CriterionTypeEnum",
    "ad_group_criterion.quality_info.post_click_quality_score": "QualityScoreBucketEnum",
    "ad_group_criterion.quality_info.search_predicted_ctr": "QualityScoreBucketEnum",
    "ad_group_criterion.gender.type": "GenderTypeEnum",
    "ad_group_criterion.parental_status.type": "ParentalStatusTypeEnum",
    "ad_group_criterion.income_range.type": "IncomeRangeTypeEnum",
}
